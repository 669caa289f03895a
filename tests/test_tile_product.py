"""The product of a bucketed store and weights bucketed alike: equal results, no exchange of the grid."""

from decimal import ROUND_HALF_UP, Decimal, getcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.operators import coverage, exact, regions, tilemeans
from chronogrid.plans import regions as jobs
from chronogrid.session import input_size, materialise, scratch_path
from chronogrid.sources.gridstore import GridStore, joins_within_buckets

getcontext().prec = 60
SPEC = GridSpec("2024-01-01 00:00:00", "day", ChunkPlan(5, 3, 4))


@pytest.fixture(scope="module")
def grid(spark):
    """20 days of 7 x 10 cells; some rows absent, some values missing."""
    n = spark.range(20 * 7 * 10)
    g = n.select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") / 70).cast("int"))).alias("time"),
                 (F.col("id") / 10 % 7).cast("int").alias("y"), (F.col("id") % 10).cast("int").alias("x"),
                 F.when(F.col("id") % 13 != 0, (F.col("id") * 7 % 101).cast("double")).alias("a"), (F.col("id") % 17).cast("double").alias("b"))
    return g.where("id % 11 <> 3") if "id" in g.columns else g.where(F.pmod(F.hash("time", "y", "x"), F.lit(11)) != 3)


@pytest.fixture(scope="module")
def store(spark, grid):
    s = GridStore.create(spark, scratch_path(spark, "bucketed"), SPEC, "2024-01-01", "2024-01-20", ["a", "b"], shape=(7, 10), buckets=12, slots=2)
    s.write_region(grid.where("x < 5"))
    s.write_region(grid.where("x >= 5"))
    s.write_region(grid.where("time < timestamp_ntz'2024-01-03 00:00:00'").withColumn("a", F.lit(1.0)))     # a partial rewrite
    return s


@pytest.fixture(scope="module")
def w(spark):
    return spark.createDataFrame([(p, y, x, 0.1 + 0.01 * (p + y * x)) for p in range(6) for y in range(7) for x in range(10) if (y + x + p) % 3],
                                 "poly_id long, y int, x int, w double")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_store_reads_alike(spark, store, grid):
    assert rows(store.read()) == rows(store.read(by_tile=True).select("time", "y", "x", "a", "b"))
    expected = grid.withColumn("a", F.when(F.col("time") < F.lit("2024-01-03").cast("timestamp_ntz"), 1.0).otherwise(F.col("a")))
    assert rows(store.read()) == rows(expected.select("time", "y", "x", "a", "b"))
    again = GridStore(spark, store.path)                      # as another session finds it
    assert again.buckets == 12 and again.read(by_tile=True).count() == grid.count()


def test_means_are_equal(spark, store, w):
    for strict in (True, False):
        broadcast = regions.weighted_mean(regions.join_weights(store.read(), w), ["a", "b"], strict=strict)
        tiles = jobs.store_means(store, w, ["a", "b"], strict=strict, limit=0)
        assert rows(tiles.select("poly_id", "time", "a", "b")) == rows(broadcast.select("poly_id", "time", "a", "b"))
    some = jobs.store_means(store, w, ["b"], "2024-01-04", "2024-01-11", limit=0)
    assert some.agg(F.min("time"), F.max("time")).first()[0].day == 4 and some.select("time").distinct().count() == 8


def test_grid_is_not_exchanged(spark, store, w):
    path = scratch_path(spark, "tile-weights")
    jobs.write_tile_weights(store, w, path)
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    with joins_within_buckets(spark):
        means = regions.weighted_mean(jobs.tile_product(store, path, ["a"]), ["a"])
        plan = means._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(key, None) == before
    assert plan.count("Bucketed: true") == 2 and "ShuffledHashJoin" in plan and "Broadcast" not in plan
    assert plan.count("Exchange") == 1                        # of the partial sums, above the join
    assert plan.index("Exchange") < plan.index("ShuffledHashJoin")


def test_plain_store_is_refused(spark, grid):
    plain = GridStore.create(spark, scratch_path(spark, "plain"), SPEC, "2024-01-01", "2024-01-20", ["a", "b"])
    with pytest.raises(ValueError, match="not bucketed"):
        plain.read(by_tile=True)


def test_product_needs_no_setting(spark, store, w):
    """The product can be given back unwritten: planned later, under any settings, the grid still isn't exchanged."""
    path = scratch_path(spark, "tile-weights")
    jobs.write_tile_weights(store, w, path)
    plan = jobs.tile_product(store, path, ["a"]).where("w > 0")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 2 and "Exchange" not in plan


def test_product_comes_in_runs(spark, store, w):
    """A polygon's steps in a cell and time chunk follow each other, in order."""
    path = scratch_path(spark, "tile-weights")
    jobs.write_tile_weights(store, w, path)
    product = jobs.tile_product(store, path)
    assert product.columns == ["time", "y", "x", "a", "b", "poly_id", "w", "n_cells"]
    at = product.select(F.spark_partition_id(), "poly_id", "y", "x", F.floor(F.datediff("time", F.lit("2024-01-01")) / 5).alias("chunk"), "time",
                        F.monotonically_increasing_id().alias("at")).collect()
    at = [tuple(r)[:-1] for r in sorted(at, key=lambda r: r["at"])]
    starts = sum(a[:-1] != b[:-1] for a, b in zip([(None,) * 6, *at], at))
    assert starts == len({a[:-1] for a in at}) < len(at) / 3
    assert all(a[-1] < b[-1] for a, b in zip(at, at[1:]) if a[:-1] == b[:-1])


def test_written_product_is_small(spark, grid):
    """20,000 polygons over three cells: a row takes less than a byte of disk, and none is lost or changed."""
    s = GridStore.create(spark, scratch_path(spark, "bucketed"), GridSpec("2024-01-01 00:00:00", "day", ChunkPlan(20, 3, 4)),
                         "2024-01-01", "2024-01-20", ["a", "b"], shape=(7, 10), buckets=4, slots=1)
    s.write_region(grid)
    cells = spark.range(60_000).select((F.col("id") / 3).cast("long").alias("poly_id"), F.lit(0).alias("y"),
                                       (F.col("id") % 3).cast("int").alias("x"), F.round(F.rand(1), 6).alias("w"))
    w, path, out = materialise(cells, "cells"), scratch_path(spark, "tile-weights"), scratch_path(spark, "product")
    jobs.write_tile_weights(s, w, path)
    jobs.tile_product(s, path).write.parquet(out)
    found = spark.read.parquet(out)
    expected = regions.join_weights(s.read(), w, checked=False).select(found.columns)
    of = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    assert tuple(of(found)) == tuple(of(expected))
    assert input_size(spark, out) < found.count(), input_size(spark, out) / found.count()
    assert jobs.tile_product(s, path).rdd.getNumPartitions() == 2 * s.buckets      # two blocks: two tasks a bucket


@pytest.mark.parametrize("strict", [True, False])
def test_small_blocks_and_pieces(spark, store, w, strict, monkeypatch):
    """Polygons over many tiles, blocks and pieces; neither products nor partial sums become rows."""
    monkeypatch.setattr(jobs, "PACKED", 40)
    monkeypatch.setattr(jobs, "PIECE_STEPS", 3)
    means = jobs.store_means(store, w, ["a", "b"], strict=strict, limit=0)
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "sum(" not in plan
    broadcast = regions.weighted_mean(regions.join_weights(store.read(), w), ["a", "b"], strict=strict)
    assert rows(means) == rows(broadcast.select("poly_id", "time", "a", "b"))
    product = store.read().join(w, ["y", "x"])
    monkeypatch.setattr(jobs, "PACKED", 7)                     # blocks of the table bucketed by tile
    path = scratch_path(spark, "tile-weights")
    jobs.write_tile_weights(store, w, path)
    keys = ["time", "y", "x", "a", "b", "poly_id", "w"]
    assert rows(jobs.tile_product(store, path).select(keys)) == rows(product.select(keys))


def test_sums_are_those_of_decimals(spark):
    rng = np.random.default_rng(1)
    v = np.concatenate([np.round(rng.random(3000), 6) * np.round(rng.random(3000) * 1e5, 2), rng.random(3000) * 10.0 ** rng.integers(-9, 15, 3000),
                        2.0 ** rng.integers(-30, 49, 500), 10.0 ** rng.integers(-12, 15, 500), [0.0, 74863264440298.38, 5e-19, 1.5e-18]])
    v[::3] *= -1
    limbs = exact.limbs(v)
    whole = [int(a) * 10 ** 18 + int(b) * 10 ** 9 + int(c) for a, b, c in zip(*limbs, strict=True)]
    assert whole == [int((Decimal(repr(x)) * 10 ** 18).quantize(Decimal(1), ROUND_HALF_UP)) for x in v.tolist()]
    sums = exact.to_double(*(x.reshape(-1, 4).sum(axis=1) for x in limbs))
    assert sums.tolist() == [float(Decimal(sum(whole[k:k + 4])).scaleb(-18)) for k in range(0, len(whole), 4)]
    with pytest.raises(ArithmeticError):
        exact.limbs(np.array([1e15]))


def test_yearly_averages_by_blocks(spark, grid, w, monkeypatch):
    """JB11 with large weights in many small blocks gives what broadcast weights give."""
    monkeypatch.setattr(jobs, "PACKED", 40)
    s = GridStore.create(spark, scratch_path(spark, "bucketed"), SPEC, "2024-01-01", "2024-01-20", ["RAIN", "T2MAX"], shape=(7, 10), buckets=4, slots=2)
    s.write_region(grid.withColumnsRenamed({"a": "RAIN", "b": "T2MAX"}))
    w_path, found = scratch_path(spark, "weights"), []
    jobs.write_weights(w, w_path)
    for limit in (0, 1 << 20):
        out = scratch_path(spark, "yearly")
        jobs.region_daily_store(s, w_path, out, 2024, 2024, ("RAIN", "T2MAX"), strict=False, limit=limit)
        found.append(rows(jobs.read_yearly(spark, out)))
    assert found[0] == found[1] and len(found[0]) == 120


def test_short_products_are_added_as_such(monkeypatch):
    """Products of short decimals need no limbs of their own, and all sums are those of single decimals."""
    rng, made, limbs = np.random.default_rng(2), [], exact.limbs
    monkeypatch.setattr(exact, "limbs", lambda x: made.append(x.size) or limbs(x))
    cells, here = rng.integers(0, 8, 600), rng.random((8, 5)) < 0.7
    owner, n_cells = np.repeat(np.arange(60), 10), np.full(60, 10)
    for w, scale, short in ((np.round(rng.random(600), 6), 1.0, True), (rng.random(600), -1.0, False), (np.round(rng.random(600), 6), 1e9, True)):
        made.clear()
        values = [np.where(rng.random(here.shape) < 0.9, np.where(here, np.round(rng.random(here.shape) * 1e5, 2) * scale, np.nan), np.nan) for _ in range(2)]
        found, means = tilemeans._means(cells, w, owner, 60, n_cells, here, values, False)
        assert sum(made) < 600 * (1 + 2 * 5) / (2 if short and scale == 1 else 1) + 1
        whole = lambda x: int((Decimal(repr(x)) * 10 ** 18).quantize(Decimal(1), ROUND_HALF_UP))
        for v, mean in zip(values, means, strict=True):
            for p in range(60):
                for t in range(5):
                    at = [k for k in range(p * 10, p * 10 + 10) if not np.isnan(v[cells[k], t])]
                    top, below = (sum(whole(float(x)) for x in of) for of in ([w[k] * v[cells[k], t] for k in at], [w[k] for k in at]))
                    assert (mean[p, t] == float(Decimal(top).scaleb(-18)) / float(Decimal(below).scaleb(-18))) if at else np.isnan(mean[p, t])
                    assert found[p, t] == any(here[cells[k], t] for k in range(p * 10, p * 10 + 10))


def test_rings_of_one_file_are_spread(spark):
    """A ring's cuts aren't made in the one task that reads its file."""
    ring = [(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (0.0, 3.0)]
    polys = spark.createDataFrame([(k, ring) for k in range(64)], "poly_id long, ring array<struct<x: double, y: double>>").coalesce(1)
    edges = coverage.crossed_cells(polys, regions.CellGrid(nx=8, ny=8))
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Generate") < plan.rindex("RoundRobinPartitioning")
