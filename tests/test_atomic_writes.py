"""Region writes that are lost at any point: the store ends in the old state or the new one, never between."""

import pytest
from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.session import hadoop_path, scratch_path
from chronogrid.sources.gridstore import GridStore

SPEC = GridSpec("2024-01-01 00:00:00", "hour", ChunkPlan(24, 2, 2))


def hours(spark, value):
    return spark.range(72).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("time"),
                                  F.lit(0).alias("y"), F.lit(0).alias("x"), F.lit(value).alias("v"))


def values(store):
    return {(r.time.day, r.v) for r in store.read().collect()}, store.read().count()


@pytest.mark.parametrize("renames, buckets", [(0, None), (1, None), (2, None), (3, None), (4, None), (5, None), (0, 4), (3, 4)])
def test_lost_while_swapping(spark, monkeypatch, renames, buckets):
    store = GridStore.create(spark, scratch_path(spark, "atomic"), SPEC, "2024-01-01", "2024-01-03 23:00:00", ["v"], buckets=buckets, slots=1)
    store.write_region(hours(spark, 1.0))
    plain = GridStore._publish

    def lost(self, swap):
        """The first renames of a publication, then nothing more."""
        fs, at = hadoop_path(self.spark, swap)
        names = sorted(s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith("time_chunk="))
        moves = []
        for n in names:
            moves += [(f"{self.path}/grid/{n}", f"{swap}/_old/{n}"), (f"{swap}/{n}", f"{self.path}/grid/{n}")]
        fs.mkdirs(hadoop_path(self.spark, f"{swap}/_old")[1])
        for a, b in moves[:renames]:
            assert fs.rename(hadoop_path(self.spark, a)[1], hadoop_path(self.spark, b)[1])
        raise RuntimeError("driver lost")
    monkeypatch.setattr(GridStore, "_publish", lost)
    with pytest.raises(RuntimeError):
        store.write_region(hours(spark, 2.0))
    monkeypatch.setattr(GridStore, "_publish", plain)
    again = GridStore(spark, store.path)
    assert values(again) == ({(1, 2.0), (2, 2.0), (3, 2.0)}, 72)
    fs, at = hadoop_path(spark, store.path)
    assert not [s for s in fs.listStatus(at) if s.getPath().getName().startswith("swap-")]


def test_lost_while_writing(spark):
    store = GridStore.create(spark, scratch_path(spark, "atomic"), SPEC, "2024-01-01", "2024-01-03 23:00:00", ["v"])
    store.write_region(hours(spark, 1.0))
    half = f"{store.path}/swap-half"
    hours(spark, 3.0).withColumns({"y_chunk": F.lit(0), "x_chunk": F.lit(0), "time_chunk": F.lit(1)}).write.partitionBy("time_chunk").parquet(half)
    fs, done = hadoop_path(spark, f"{half}/_SUCCESS")
    fs.delete(done, False)
    store.write_region(hours(spark, 2.0).where("time < timestamp_ntz'2024-01-02 00:00:00'"))
    assert values(GridStore(spark, store.path)) == ({(1, 2.0), (2, 1.0), (3, 1.0)}, 72)
    assert not fs.exists(hadoop_path(spark, half)[1])
