"""Statistics kept with a store: equal to a scan after any write, and read instead of the grid."""

import re

import pytest
from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.operators import quality as qa
from chronogrid.plans import checks
from chronogrid.session import scratch_path
from chronogrid.sources import summaries
from chronogrid.sources.gridstore import GridStore

SPEC = GridSpec("2023-12-25 00:00:00", "hour", ChunkPlan(70, 2, 2))     # chunks of two words of bits; one spans two years
NY, NX = 3, 4


@pytest.fixture
def store(spark):
    """Ten days around New Year of 3 x 4 cells, all values there."""
    g = (spark.range(240 * NY * NX).select(
        (F.lit("2023-12-27").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("id") / (NY * NX)).cast("int"))).alias("time"),
        (F.col("id") / NX % NY).cast("int").alias("y"), (F.col("id") % NX).cast("int").alias("x"),
        (F.col("id") * 31 % 1009).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b")))
    s = GridStore.create(spark, scratch_path(spark, "summed"), SPEC, "2023-12-27", "2024-01-05 23:00:00", ["a", "b"], shape=(NY, NX), summaries=True)
    s.write_region(g)
    return s


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def agrees(store):
    grid, axis = store.read(), store.axis()
    assert rows(checks.yearly_range_store(store)) == rows(qa.yearly_range(grid, axis, NY * NX, store.variables))
    assert rows(checks.count_present_store(store)) == rows(qa.count_present(grid, store.variables))
    assert rows(checks.check_missing_store(store)) == rows(checks.check_missing(grid, axis, NY * NX, store.variables))
    assert rows(checks.check_min_max_store(store, ["b"])) == rows(checks.check_min_max(grid, axis, NY * NX, ["b"]))
    dense = axis.select("time").join(grid, "time", "left").groupBy("time").agg(F.count("a").alias("a"), F.count("b").alias("b")).collect()
    missing = sorted((v, r["time"]) for r in dense for v in ("a", "b") if r[v] < NY * NX)
    assert sorted(map(tuple, summaries.incomplete_steps(store).collect())) == missing


def grid_scans(df):
    """Partition filters of the plan's scans of the grid."""
    spark, key = df.sparkSession, "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    return [re.search(r"PartitionFilters: (\[.*?\])(?:, Pushed|$)", line)[1] for line in plan.splitlines() if re.search(r"InMemoryFileIndex.*/grid\]", line)]


def test_whole_store(spark, store):
    assert rows(summaries.incomplete_steps(store)) == []
    agrees(store)
    assert all(r["min_value"] is not None for r in checks.yearly_range_store(store).collect())
    assert grid_scans(checks.yearly_range_store(store)) == []
    assert grid_scans(qa.yearly_range(store.read(), store.axis(), 12, ["a"])) != []


def test_partial_rewrites(spark, store):
    t = F.col("time")
    g = store.read()
    store.write_region(g.where((t >= F.lit("2023-12-31 20:00:00").cast("timestamp_ntz")) & (t < F.lit("2024-01-01 03:00:00").cast("timestamp_ntz")) & (F.col("x") == 1))
                       .select("time", "y", "x", F.lit(None).cast("double").alias("a")))
    agrees(store)
    g = store.read()
    store.write_region(g.where("y < 2").select("time", "y", "x", (F.col("b") - 100).alias("b")))
    agrees(store)
    g = store.read()
    store.write_region(g.where(t == F.lit("2024-01-04 05:00:00").cast("timestamp_ntz")).where("x < 3"), replace_chunks=True)
    agrees(store)
    assert grid_scans(checks.check_missing_store(store)) == []


def test_stale_chunks_are_scanned_and_no_others(spark, store):
    g = store.read()
    last = g.where(F.col("time") >= F.lit("2024-01-05 18:00:00").cast("timestamp_ntz"))
    store.write_region(last.select("time", "y", "x", F.lit(-5.0).alias("a")), summarise=False)     # as a job lost in between leaves it
    agrees(store)
    df = checks.yearly_range_store(store)
    assert [re.findall(r"(?:time_chunk#\d+ = |IN \()([\d,]+)", f) for f in grid_scans(df)] == [["4"]]
    summaries.write_summaries(store, [4])
    assert grid_scans(checks.yearly_range_store(store)) == []
    agrees(store)


def test_empty_store(spark):
    s = GridStore.create(spark, scratch_path(spark, "none"), SPEC, "2023-12-27", "2023-12-27 05:00:00", ["a"], shape=(1, 1), summaries=True)
    assert [tuple(r) for r in checks.check_missing_store(s).collect()] == [("a", "2023", "6")]
    assert summaries.incomplete_steps(s).count() == 6
