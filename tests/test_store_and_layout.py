"""Grid store: region writes, pruning, axis extension, chunk files."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.operators import grid as gops
from chronogrid.operators import layout
from chronogrid.session import scratch_path
from chronogrid.sources import arraystore
from chronogrid.sources.gridstore import GridStore

SPEC = GridSpec("2024-01-01 00:00:00", "hour", ChunkPlan(4, 2, 2))


def formula_grid(spark, gaps=((1, 0, 1), (3, 3, 3), (6, 2, 0))):
    """F8: v = 100 t + 10 y + x on 8 x 4 x 4 with planted gaps."""
    df = spark.range(8 * 16).select((F.col("id") / 16).cast("int").alias("t"),
                                    ((F.col("id") / 4).cast("int") % 4).alias("y"), (F.col("id") % 4).cast("int").alias("x"))
    for t, y, x in gaps:
        df = df.where(~((F.col("t") == t) & (F.col("y") == y) & (F.col("x") == x)))
    time = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(F.lit(0), F.col("t"), F.lit(0), F.lit(0))
    return df.select(time.alias("time"), "y", "x", (F.col("t") * 100 + F.col("y") * 10 + F.col("x")).cast("double").alias("v"))


def new_store(spark, end="2024-01-01 07:00:00"):
    return GridStore.create(spark, scratch_path(spark, "t-store"), SPEC, "2024-01-01 00:00:00", end, ["v"])


def test_region_write_keeps_other_hours_and_is_idempotent(spark):
    g = formula_grid(spark)
    st = new_store(spark)
    st.write_region(g)
    st.write_region(g.where("time = TIMESTAMP_NTZ '2024-01-01 02:00:00'"))   # one hour of chunk 0
    st.write_region(g.where("time >= TIMESTAMP_NTZ '2024-01-01 04:00:00'"))   # re-run chunk 1
    assert st.read().exceptAll(g).count() == 0 and g.exceptAll(st.read()).count() == 0


def test_write_outside_axis_fails(spark):
    st = new_store(spark)
    bad = formula_grid(spark).withColumn("time", F.col("time") + F.expr("INTERVAL 30 MINUTES"))
    with pytest.raises(Exception):
        st.write_region(bad)
    with pytest.raises(ValueError):
        st.write_region(formula_grid(spark).withColumn("extra", F.lit(1.0)))


def test_read_prunes_partitions(spark):
    st = new_store(spark)
    st.write_region(formula_grid(spark))
    df = st.read(start="2024-01-01 04:00:00", end="2024-01-01 07:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(time_chunk" in plan and "(time_chunk#" in plan
    assert "PushedFilters: [IsNotNull(time), GreaterThanOrEqual(time" in plan
    assert df.count() == 4 * 16 - 1


def test_extend_time(spark):
    st = new_store(spark)
    assert st.extend_time("2024-01-01 11:00:00")
    assert not st.extend_time("2024-01-01 11:00:00")
    with pytest.raises(ValueError):
        st.extend_time("2024-01-01 09:00:00")
    assert [r[0] for r in st.axis().orderBy("time_idx").select("time_idx").collect()] == list(range(12))
    st.write_region(formula_grid(spark).withColumn("time", F.col("time") + F.expr("INTERVAL 4 HOURS")))
    info = st.info().first()
    assert info["last_chunk"] == 2 and not info["partial_last_chunk"]


def test_rechunk_preserves_rows_and_tiles(spark):
    g = formula_grid(spark)
    r = layout.rechunk(g, SPEC)
    assert r.drop(*layout.TILE).exceptAll(g).count() == 0 and r.count() == g.count()
    per_part = r.select(F.spark_partition_id().alias("p"), *layout.TILE).distinct().groupBy(*layout.TILE).count()
    assert per_part.where("count > 1").count() == 0       # a tile never spans two tasks


def test_array_store_roundtrip(spark):
    g = gops.with_time_index(formula_grid(spark), "2024-01-01 00:00:00", 3600)
    path = scratch_path(spark, "t-arrays")
    m = arraystore.export_array_store(g, path, ["v"], (8, 4, 4), (3, 3, 2))
    assert m.count() == 3 * 2 * 2
    back = arraystore.import_array_store(spark, path, ["v"])
    assert back.count() == 8 * 16
    got = {(r["time_idx"], r["y"], r["x"]): r["v"] for r in back.collect()}
    assert got[(1, 0, 1)] is None and got[(5, 2, 3)] == 523.0
    import zstandard
    raw = open(f"{path}/v/0.0.0", "rb").read()
    arr = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype="<f8").reshape(3, 3, 2)
    assert arr[2, 1, 1] == 211.0


def test_dense_view_counts(spark):
    g = formula_grid(spark)
    ax = gops.make_axis(spark, "2024-01-01 00:00:00", "2024-01-01 07:00:00", SPEC)
    d = gops.dense_view(g, ax.select("time_idx", "time"), 4, 4)
    assert d.count() == 8 * 16 and d.where("v IS NULL").count() == 3


def test_spatial_read_pushes_tile_filters(spark):
    st = new_store(spark)
    st.write_region(formula_grid(spark))
    df = st.read(y_range=(2, 3), x_range=(0, 1), start="2024-01-01 00:00:00", end="2024-01-01 03:00:00")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")    # untruncated PushedFilters
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(y_chunk,1)" in plan and "LessThanOrEqual(x,1)" in plan
    got = {(r["y"], r["x"]) for r in df.collect()}
    assert got == {(2, 0), (2, 1), (3, 0), (3, 1)} and df.count() == 4 * 4


def test_array_import_in_small_frames_equals_whole(spark):
    g = gops.with_time_index(formula_grid(spark), "2024-01-01 00:00:00", 3600)
    path = scratch_path(spark, "t-arrays2")
    arraystore.export_array_store(g, path, ["v"], (8, 4, 4), (5, 3, 3)).write.format("noop").mode("overwrite").save()
    whole = arraystore.import_array_store(spark, path, ["v"])
    small = arraystore.import_array_store(spark, path, ["v"], rows_per_frame=4, keep_missing=False)
    assert whole.count() == 8 * 16 and small.count() == 8 * 16 - 3
    assert small.exceptAll(whole.where("v IS NOT NULL")).count() == 0


def test_export_per_variable_and_together_write_same_chunks(spark):
    g = gops.with_time_index(formula_grid(spark), "2024-01-01 00:00:00", 3600).withColumn("w", F.col("v") * 2)
    p1, p2 = scratch_path(spark, "t-a1"), scratch_path(spark, "t-a2")
    m1 = arraystore.export_array_store(g, p1, ["v", "w"], (8, 4, 4), (4, 2, 4), per_variable=True)
    m2 = arraystore.export_array_store(g, p2, ["v", "w"], (8, 4, 4), (4, 2, 4), per_variable=False)
    assert sorted(r[:2] + r[3:4] for r in m1.collect()) == sorted(r[:2] + r[3:4] for r in m2.collect())
    a = arraystore.import_array_store(spark, p1).orderBy("time_idx", "y", "x").collect()
    b = arraystore.import_array_store(spark, p2).orderBy("time_idx", "y", "x").collect()
    assert a == b and len(a) == 8 * 16


def test_float_input_and_store_checks(spark):
    from chronogrid.plans import checks
    st = new_store(spark)
    g = formula_grid(spark).withColumn("v", F.col("v").cast("float"))
    st.write_region(g)
    assert dict(st.read().dtypes)["v"] == "double" and st.read().count() == 8 * 16 - 3
    st.write_constants(gops.make_cells(spark, 4, 4))
    rep = {(r["Variable"], r["Year"]): r["Max missing"] for r in checks.check_missing_store(st, ["v"]).collect()}
    assert rep == {("v", "2024"): "1"}
    mm = checks.check_min_max_store(st, ["v"]).first()
    assert mm["min_txt"] is None                                 # gaps make the year strict-missing


def test_partial_cover_detection_with_offset_axis(spark):
    """Axis starting inside a chunk: a write covering the rest of that chunk
    counts as complete; a later partial write keeps the other rows."""
    spec = GridSpec("2024-01-01 00:00:00", "hour", ChunkPlan(4, 2, 2))
    st = GridStore.create(spark, scratch_path(spark, "t-off"), spec, "2024-01-01 02:00:00", "2024-01-01 07:00:00", ["v"])
    g = formula_grid(spark).where("time >= TIMESTAMP_NTZ '2024-01-01 02:00:00'")
    st.write_region(g)
    st.write_region(g.where("time = TIMESTAMP_NTZ '2024-01-01 05:00:00'").withColumn("v", F.lit(-1.0)))
    got = st.read()
    assert got.count() == g.count() and got.where("v = -1.0").count() == 16
