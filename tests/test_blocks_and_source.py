"""Rechunking by blocks and the array data source."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronogrid.session import scratch_path, ship_package
from chronogrid.sources import arraystore, blocks, datasource


@pytest.fixture(scope="module")
def ready(spark):
    ship_package(spark)
    datasource.register_source(spark)
    return spark


def array_rows(shape, some=lambda t, y, x: True):
    return [(t, y, x, float(t * 10000 + y * 100 + x), None if (t + x) % 5 == 0 else float(y)) for t in range(shape[0])
            for y in range(shape[1]) for x in range(shape[2]) if some(t, y, x)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "time_idx int, y int, x int, a double, b double").repartition(4)


SHAPE = (23, 7, 11)


@pytest.fixture(scope="module")
def store(ready):
    path = scratch_path(ready, "array")
    datasource.write_array(frame(ready, array_rows(SHAPE, lambda t, y, x: not (t < 5 and y < 3))), path, SHAPE, (5, 3, 4))
    return path


def read(spark, path, **options):
    return sorted(tuple(r) for r in datasource.read_array(spark, path, ["a", "b"], **options).collect() if True)


def key(rows):
    return sorted(rows, key=lambda r: r[:3])


@pytest.mark.parametrize("chunks", [(23, 1, 1), (1, 7, 11), (4, 4, 4), (100, 100, 100), (5, 3, 4)])
def test_rechunk_keeps_values(ready, store, chunks):
    target = scratch_path(ready, "target")
    manifest = blocks.rechunk_array_store(ready, store, target, dict(zip(("time", "y", "x"), chunks)))
    size = tuple(min(c, s) for c, s in zip(chunks, SHAPE))
    meta = arraystore.read_array_meta(target)
    assert meta["a/.zarray"]["chunks"] == list(size) and meta["a/.zarray"]["shape"] == list(SHAPE)
    want = key(array_rows(SHAPE, lambda t, y, x: not (t < 5 and y < 3)))
    got = datasource.read_array(ready, target, missing=False).collect()
    assert key(tuple(r) for r in got) == want
    # the same through the other reader, absent positions as NULL
    other = arraystore.import_array_store(ready, target, ["a", "b"]).where("a IS NOT NULL OR b IS NOT NULL").collect()
    assert key(tuple(r) for r in other) == want
    assert {r.variable for r in manifest.collect()} == {"a", "b"}


def test_bytes_exchanged(ready):
    """Sub-blocks hold the array's bytes once, and few other columns."""
    shape, path = (96, 40, 50), scratch_path(ready, "big")
    grid = ready.range(shape[0] * shape[1] * shape[2]).select(
        (F.col("id") / 2000).cast("int").alias("time_idx"), (F.col("id") / 50 % 40).cast("int").alias("y"), (F.col("id") % 50).cast("int").alias("x"), F.rand(1).alias("a"))
    datasource.write_array(grid, path, shape, (12, 40, 50))
    pieces = blocks.cut(blocks.read_blocks(ready, path), (48, 10, 10))
    stats = pieces.agg(F.sum(F.octet_length("data")), F.count("*")).first()
    array_bytes = int(np.prod(shape)) * 8
    assert stats[0] == array_bytes
    assert stats[0] + 100 * stats[1] <= 1.2 * array_bytes
    plan = blocks.assemble(pieces, (48, 10, 10), shape)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_overlap_fails(ready, store):
    pieces = blocks.cut(blocks.read_blocks(ready, store, ["a"]), (5, 3, 4))
    with pytest.raises(Exception, match="sub-blocks overlap"):
        blocks.assemble(pieces.unionByName(pieces), (5, 3, 4), SHAPE).count()


def test_filters_open_only_their_chunks(ready, store):
    path = scratch_path(ready, "poisoned")
    rows = array_rows(SHAPE)
    datasource.write_array(frame(ready, rows), path, SHAPE, (5, 3, 4))
    for v in ("a", "b"):
        for name in os.listdir(f"{path}/{v}"):
            if name not in ("2.1.0", "2.1.1", "3.1.0", "3.1.1") and not name.startswith("."):
                with open(f"{path}/{v}/{name}", "wb") as f:
                    f.write(b"no chunk at all")
    df = datasource.read_array(ready, path)
    inside = df.where("time_idx >= 10 AND time_idx < 20 AND y IN (3, 5) AND x <= 7 AND a IS NOT NULL")
    assert key(tuple(r) for r in inside.collect()) == key(r for r in rows if 10 <= r[0] < 20 and r[1] in (3, 5) and r[2] <= 7)
    one = df.where((F.col("time_idx") == 12) & (F.col("y") == 4) & (F.col("x") > 5) & (F.col("x") < 7))
    assert [r.a for r in one.collect()] == [120406.0]
    assert df.where("time_idx > 100").count() == 0 and df.where("y < 0").count() == 0
    with pytest.raises(Exception):
        df.where("time_idx >= 9 AND y = 3").collect()


def test_missing_rows(ready, store):
    every = datasource.read_array(ready, store)
    assert every.count() == int(np.prod(SHAPE)) and every.where("a IS NULL AND b IS NULL").count() == 5 * 3 * 11
    assert datasource.read_array(ready, store, ["b"], missing=False).where("b IS NULL").count() == 0


def test_commit_is_all_or_nothing(ready):
    path, rows = scratch_path(ready, "committed"), array_rows((6, 4, 4))
    good = frame(ready, rows)
    datasource.write_array(good, path, (6, 4, 4), (3, 2, 2))
    with pytest.raises(Exception, match="outside the shape"):
        datasource.write_array(frame(ready, rows + [(99, 0, 0, 1.0, 1.0)]), path, (6, 4, 4), (3, 2, 2), mode="overwrite")
    with pytest.raises(Exception, match="two rows at one position"):
        datasource.write_array(frame(ready, rows + rows[:1]), path, (6, 4, 4), (3, 2, 2), mode="overwrite")
    with pytest.raises(Exception, match="mode overwrite"):
        datasource.write_array(good, path, (6, 4, 4), (3, 2, 2))
    assert not [n for n in os.listdir(path) if n.startswith("_staging")]
    assert key(tuple(r) for r in datasource.read_array(ready, path, missing=False).collect()) == key(rows)
    datasource.write_array(good.where("time_idx < 2").select("time_idx", "y", "x", "b"), path, (2, 4, 4), (2, 4, 4), mode="overwrite")
    assert not os.path.exists(f"{path}/a") and datasource.read_array(ready, path).count() == 32


def test_chunk_in_two_tasks_fails(ready):
    path = scratch_path(ready, "split")
    rows = frame(ready, array_rows((4, 2, 2))).repartition(2, "time_idx").sortWithinPartitions("time_idx")
    with pytest.raises(Exception, match="by_chunk"):
        rows.write.format(datasource.FORMAT).option("shape", "4,2,2").option("chunks", "4,2,2").mode("append").save(path)
    assert not os.path.exists(f"{path}/.zmetadata")
