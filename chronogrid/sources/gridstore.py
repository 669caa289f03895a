"""Chunked grid store on Parquet.

Layout of a store directory::

    grid/time_chunk=<n>/*.parquet   rows (time, y, x, <variables>, y_chunk, x_chunk)
    axis/                           (time_idx, time, time_chunk): the full time axis
    summary/time_chunk=<n>/         statistics of the chunk, where the store keeps them (see summaries)
    cells/                          (y, x, <constants>)
    catalog/                        (varname, dims, attrs, encoding)
    _spec                      base date, step, chunk plan

The grid is partitioned by ``time_chunk`` (one directory per time chunk) and
clustered by ``y_chunk, x_chunk`` inside, so a chunk of the array maps to a
group of files and a region write replaces whole partitions.

A store created with ``buckets`` is bucketed as well, by tile and *slot* (the time
chunk modulo ``slots``): a table bucketed alike joins it tile by tile with no exchange
of the grid, in as many tasks as there are tiles times slots (up to ``buckets``).
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import hashlib
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ChunkPlan, GridSpec, parse_base_date
from ..functions import timeaxis as ta
from ..functions.values import mask_missing
from ..operators import grid as gops
from ..session import hadoop_path, remove_path, scratch_path

CATALOG_SCHEMA = T.StructType([
    T.StructField("varname", T.StringType(), False),
    T.StructField("dims", T.ArrayType(T.StringType()), False),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("encoding", T.MapType(T.StringType(), T.StringType()), True),
])


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text document as a one-row text dataset (any file system)."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def catalog_frame(spark: SparkSession, rows) -> DataFrame:
    """Catalog DataFrame from ``(varname, dims, attrs, encoding)`` tuples."""
    return spark.createDataFrame(list(rows), CATALOG_SCHEMA)


#: What a bucketed table is bucketed by.
BUCKET_KEYS = ("y_chunk", "x_chunk", "slot")


def bucketed_table(spark: SparkSession, path: str, schema: str, buckets: int, partitioned_by: str = "") -> str:
    """Name of the session's table over the bucketed Parquet files at ``path``.

    The catalog holds only where the files lie and how they are bucketed; each session
    that reads or writes them names them anew."""
    name = "tiles_" + hashlib.sha256(path.encode()).hexdigest()[:24]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') {partitioned_by} "
              f"CLUSTERED BY ({', '.join(BUCKET_KEYS)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if partitioned_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


@contextlib.contextmanager
def joins_within_buckets(spark: SparkSession) -> Iterator[None]:
    """Joins run inside use a partitioning by some of their keys as it is (by tile, for keys tile and cell)."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class GridStore:
    def __init__(self, spark: SparkSession, path: str, meta: dict | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        meta = meta or json.loads(_read_text(spark, f"{self.path}/_spec"))
        self.meta = meta
        self.spec = GridSpec(meta["base_date"], meta["freq"], ChunkPlan(**meta["plan"]))
        self.variables: list[str] = meta["variables"]
        self.axis_start: str = meta["axis_start"]
        self.n_steps: int = int(meta["n_steps"])
        self.recover()

    def _save_meta(self) -> None:
        _write_text(self.spark, f"{self.path}/_spec", json.dumps(self.meta))

    # ------------------------------------------------------------------ SR15/16
    @classmethod
    def create(cls, spark: SparkSession, path: str, spec: GridSpec, start, end,
               variables, catalog: DataFrame | None = None, cells: DataFrame | None = None,
               shape: tuple[int, int] | None = None, buckets: int | None = None, slots: int = 64,
               summaries: bool = False) -> "GridStore":
        """Empty store: full axis ``start..end``, no data rows, schema from ``variables``.

        Metadata only: the axis is generated in parallel, the grid directory is
        created empty, and every later read uses the explicit schema.  A store that
        is already at ``path`` is replaced, rows and all.  ``shape`` (y and x cells)
        tells the checks how many cells there are where no cell table does.
        ``buckets`` (about tiles x ``slots``) makes a bucketed store; with ``summaries``
        every region write renews the statistics of its chunks."""
        path = path.rstrip("/")
        axis = gops.make_axis(spark, start, end, spec)
        axis.write.mode("overwrite").parquet(f"{path}/axis")
        schema = cls._grid_schema(variables, bool(buckets))
        (spark.createDataFrame([], schema).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("time_chunk").parquet(f"{path}/grid"))
        if catalog is None:
            catalog = catalog_frame(spark, [(v, ["time", "y", "x"], {}, {}) for v in variables])
        catalog.write.mode("overwrite").parquet(f"{path}/catalog")
        if cells is not None:
            cells.write.mode("overwrite").parquet(f"{path}/cells")
        if summaries:
            (spark.createDataFrame([], "files string, time_chunk int").write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy("time_chunk").parquet(f"{path}/summary"))
        s, e = parse_base_date(start), parse_base_date(end)
        n_steps = int((e - s).total_seconds() // spec.step_seconds) + 1
        meta = {"base_date": spec.base_literal, "freq": spec.freq, "plan": spec.plan.as_dict(),
                "variables": list(variables), "axis_start": s.strftime("%Y-%m-%d %H:%M:%S"), "n_steps": n_steps,
                "has_cells": cells is not None, "n_cells": None if shape is None else int(shape[0]) * int(shape[1]),
                "buckets": buckets, "slots": slots if buckets else None, "summaries": summaries}
        _write_text(spark, f"{path}/_spec", json.dumps(meta))
        return cls(spark, path, meta)

    @staticmethod
    def _grid_schema(variables, bucketed: bool = False) -> T.StructType:
        fields = [T.StructField("time", T.TimestampNTZType()), T.StructField("y", T.IntegerType()),
                  T.StructField("x", T.IntegerType())]
        fields += [T.StructField(v, T.DoubleType()) for v in variables]
        chunks = ["y_chunk", "x_chunk", *["slot"] * bucketed, "time_chunk"]
        return T.StructType(fields + [T.StructField(c, T.IntegerType()) for c in chunks])

    @property
    def buckets(self) -> int | None:
        return self.meta.get("buckets")

    @property
    def slots(self) -> int:
        return int(self.meta.get("slots") or 1)

    @property
    def keeps_summaries(self) -> bool:
        return bool(self.meta.get("summaries"))

    @property
    def schema(self) -> T.StructType:
        return self._grid_schema(self.variables, bool(self.buckets))

    def _table(self) -> str:
        """The grid as a bucketed table of this session."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        return bucketed_table(self.spark, f"{self.path}/grid", columns, self.buckets, "PARTITIONED BY (time_chunk)")

    # ------------------------------------------------------------------ tables
    def axis(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/axis")

    def catalog(self) -> DataFrame:
        return self.spark.read.schema(CATALOG_SCHEMA).parquet(f"{self.path}/catalog")

    @property
    def has_cells(self) -> bool:
        return bool(self.meta["has_cells"])

    def cells(self) -> DataFrame:
        if not self.has_cells:
            raise ValueError(f"{self.path} has no cell table")
        return self.spark.read.parquet(f"{self.path}/cells")

    def n_cells(self) -> int:
        """Cells of the grid, written or not: from its shape, else its cell table."""
        if self.meta["n_cells"] is not None:
            return int(self.meta["n_cells"])
        return self.cells().count()

    # ------------------------------------------------------------------ SR05
    def read(self, variables=None, start=None, end=None, chunks: tuple[int, int] | None = None,
             with_chunks: bool = False, with_attrs: bool = False,
             y_range: tuple[int, int] | None = None, x_range: tuple[int, int] | None = None,
             steps: tuple[int, int] | None = None, by_tile: bool = False) -> DataFrame:
        """Lazy scan with the explicit schema.

        ``start``/``end`` (inclusive labels) become range predicates on raw
        ``time`` *and* a ``time_chunk BETWEEN`` partition filter, since Spark
        does not derive the latter itself.  ``y_range``/``x_range`` (inclusive
        cell indices) filter the clustering columns and the cell keys; both are
        pushed to Parquet, whose row-group statistics skip other tiles.  ``steps``
        (half-open axis positions) is turned into such times.  ``by_tile`` reads a bucketed
        store as such, with the columns it is bucketed by."""
        if by_tile:
            if not self.buckets:
                raise ValueError(f"{self.path} is not bucketed by tile")
            df = self.spark.table(self._table())
        else:
            df = self.spark.read.schema(self.schema).option("mergeSchema", "false").parquet(f"{self.path}/grid")
        plan = self.spec.plan
        for col, chunk_col, size, rng in (("y", "y_chunk", plan.y, y_range), ("x", "x_chunk", plan.x, x_range)):
            if rng is not None:
                lo, hi = int(rng[0]), int(rng[1])
                df = df.where(F.col(chunk_col).between(lo // size, hi // size) & F.col(col).between(lo, hi))
        if chunks is not None:
            df = df.where(F.col("time_chunk").between(int(chunks[0]), int(chunks[1])))
        if steps is not None:
            first = parse_base_date(self.axis_start)
            step = _dt.timedelta(seconds=self.spec.step_seconds)
            df = gops.slice_by_label(df, (first + steps[0] * step).strftime("%Y-%m-%d %H:%M:%S"),
                                     (first + (steps[1] - 1) * step).strftime("%Y-%m-%d %H:%M:%S"), self.spec)
        if start is not None or end is not None:
            s = start or "0001-01-01"
            e = end or "9999-12-30"
            df = gops.slice_by_label(df, s, e, self.spec)
        cols = list(variables) if variables is not None else self.variables
        keep = list(gops.KEYS) + cols + ["time_chunk"] * with_chunks + (list(BUCKET_KEYS) if by_tile else ["y_chunk", "x_chunk"] * with_chunks)
        out = df.select(*keep)
        if with_attrs:
            from ..operators.catalog import attrs_of, with_attrs as attach
            out = attach(out, attrs_of(self.catalog(), cols))
        return out

    # ------------------------------------------------------------------ SR17
    def write_region(self, df: DataFrame, replace_chunks: bool = False, stage: bool = True, summarise: bool = True) -> None:
        """Merge rows into the store by ``(time, y, x)`` and variable, idempotently.

        A row of ``df`` sets the variables that ``df`` has, a NULL or NaN included
        (NaN is stored as NULL); variables it lacks, and stored rows it doesn't
        name, stay.  So an hour may arrive in any number of writes.  Rows that repeat
        a position count once, by the largest value.  With ``replace_chunks`` the
        time chunks in ``df`` are replaced whole instead.  Every incoming time must
        lie on the axis, else the job fails.

        IO: the input is evaluated once, into a staged table that is deleted
        afterwards (``stage=False`` skips it for inputs that are cheap to read and
        can't change); its time chunks are listed from there (one row each), and only
        those partitions are read and rewritten, in one exchange by tile.  New chunks are
        written beside the grid and swapped in when all are there (``recover`` ends a swap
        that was lost).  A store that
        keeps summaries then reads the written chunks once more for theirs (unless
        ``summarise`` is False: they are stale until ``write_summaries`` or a check's scan)."""
        unknown = [c for c in df.columns if c not in gops.KEYS and c not in self.variables]
        if unknown:
            raise ValueError(f"columns not in store schema: {unknown}")
        self.recover()
        given = [v for v in self.variables if v in df.columns]
        tile = ["time_chunk", "y_chunk", "x_chunk"]
        incoming = mask_missing(gops.with_chunk_columns(self.locate(df), self.spec), given).select(
            *gops.KEYS, *[F.col(v).cast("double").alias(v) for v in given], *tile)
        staged = scratch_path(self.spark, "region") if stage else None
        if staged:
            schema = incoming.schema
            incoming.write.parquet(staged)
            incoming = self.spark.read.schema(schema).parquet(staged)
        chunks = sorted(r["time_chunk"] for r in incoming.select("time_chunk").distinct().collect())
        if chunks:
            nothing = [F.lit(None).cast("double").alias(v) for v in self.variables if v not in given]
            rows = incoming.select("*", *nothing, F.lit(1).alias("_new"))
            if not replace_chunks:
                stored = self.spark.read.schema(self.schema).parquet(f"{self.path}/grid").where(F.col("time_chunk").isin(chunks))
                rows = rows.unionByName(stored.drop("slot").withColumn("_new", F.lit(0)))
            is_new = F.col("_new") == 1
            old = {v: F.max(F.when(~is_new, F.col(v))) for v in self.variables}
            value = {v: F.when(F.max("_new") == 1, F.max(F.when(is_new, F.col(v)))).otherwise(old[v]) if v in given else old[v]
                     for v in self.variables}
            # grouped within the tiles' partitions: no second exchange
            slot = F.pmod("time_chunk", F.lit(self.slots)).cast("int")
            dealt = rows.repartition("y_chunk", "x_chunk", slot) if self.buckets else rows.repartition(*tile)
            merged = dealt.groupBy(*tile, *gops.KEYS).agg(*[c.alias(v) for v, c in value.items()])
            self._write_partitions(merged.withColumn("slot", slot).select(*self.schema.names))
            if self.keeps_summaries and summarise:
                from .summaries import write_summaries
                write_summaries(self, chunks)
        if staged:
            remove_path(self.spark, staged)

    def locate(self, df: DataFrame) -> DataFrame:
        """Axis position of each row; a time off the axis fails the job."""
        return gops.locate_regular(df, self.axis_start, self.n_steps, self.spec.step_seconds)

    def _write_partitions(self, df: DataFrame) -> None:
        """Writes whole time chunks beside the grid, then swaps them in; see ``recover``."""
        swap = f"{self.path}/swap-{uuid.uuid4().hex}"
        if self.buckets:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            fs, at = hadoop_path(self.spark, swap)
            fs.mkdirs(at)
            table = bucketed_table(self.spark, swap, columns, self.buckets, "PARTITIONED BY (time_chunk)")
            df.write.insertInto(table)
            self.spark.sql(f"DROP TABLE {table}")        # of the catalog: the files stay
        else:
            (df.sortWithinPartitions("time_chunk", "y_chunk", "x_chunk", "time", "y", "x")
             .write.partitionBy("time_chunk").parquet(swap))
        self._publish(swap)

    def _publish(self, swap: str) -> None:
        """Moves the chunks of a finished write into the grid, the old ones out of it: two renames a chunk.

        Done again after a loss at any point, it ends in the same state."""
        fs, at = hadoop_path(self.spark, swap)
        for status in fs.listStatus(at):
            name = status.getPath().getName()
            if not name.startswith("time_chunk="):
                continue
            _, target = hadoop_path(self.spark, f"{self.path}/grid/{name}")
            _, old = hadoop_path(self.spark, f"{swap}/_old/{name}")
            if fs.exists(target):
                fs.mkdirs(old.getParent())
                if not fs.rename(target, old):
                    raise OSError(f"can't move {target} out of the grid")
            if not fs.rename(status.getPath(), target):
                raise OSError(f"can't move {status.getPath()} into the grid")
        fs.delete(at, True)

    def recover(self) -> None:
        """Ends region writes that were lost: those whose chunks were all written are swapped in, others dropped.

        Called when a store is opened and before it is written; a store has one writer at a time."""
        fs, at = hadoop_path(self.spark, self.path)
        for status in fs.listStatus(at):
            if status.getPath().getName().startswith("swap-"):
                swap = f"{self.path}/{status.getPath().getName()}"
                if fs.exists(hadoop_path(self.spark, f"{swap}/_SUCCESS")[1]):
                    self._publish(swap)
                else:
                    fs.delete(status.getPath(), True)

    # ------------------------------------------------------------------ SR18
    def write_constants(self, cells: DataFrame, catalog_rows: DataFrame | None = None) -> None:
        """Add or replace constant variables of the cell table, and their catalog rows.

        Variables that ``cells`` lacks and cells that it doesn't name stay."""
        if self.has_cells:
            stored = self.cells()
            both = [c for c in stored.columns if c in cells.columns and c not in gops.CELL_KEYS]
            j = stored.alias("o").join(cells.withColumn("_new", F.lit(1)).alias("n"), list(gops.CELL_KEYS), "full")
            cells = j.select(*gops.CELL_KEYS, *[
                F.when(F.col("_new") == 1, F.col(f"n.`{c}`")).otherwise(F.col(f"o.`{c}`")).alias(c) if c in both else F.col(f"o.`{c}`")
                for c in stored.columns if c not in gops.CELL_KEYS], *[
                F.col(f"n.`{c}`") for c in cells.columns if c not in stored.columns])
        self._replace_table(cells, "cells")
        self.meta["has_cells"] = True
        self._save_meta()
        if catalog_rows is not None:
            names = catalog_rows.select("varname")
            self.write_catalog(self.catalog().join(names, "varname", "left_anti").unionByName(catalog_rows))

    def _replace_table(self, df: DataFrame, name: str) -> None:
        """Overwrite a small table that ``df`` may be derived from."""
        staged = scratch_path(self.spark, name)
        df.write.parquet(staged)
        self.spark.read.schema(df.schema).parquet(staged).write.mode("overwrite").parquet(f"{self.path}/{name}")
        remove_path(self.spark, staged)

    def write_catalog(self, catalog: DataFrame) -> None:
        """Replace the catalog (staged first: it may be derived from itself)."""
        self._replace_table(catalog.select("varname", "dims", "attrs", "encoding"), "catalog")

    # ------------------------------------------------------------------ JB05
    def extend_time(self, end) -> bool:
        """Lengthen the axis to ``end`` without touching data.

        No-op when the axis already ends there; an earlier end is rejected (the
        reference would shrink the axis).  Only the missing axis rows are
        appended.  Returns True when rows were added."""
        ax = self.axis()
        ends = ax.agg(F.min("time").alias("first"), F.max("time").alias("last")).collect()[0]   # two scalars
        new_end = parse_base_date(end)
        if new_end < ends["last"]:
            raise ValueError(f"end {new_end} is before the axis end {ends['last']}")
        grown = not ta.axis_up_to_date(ends["last"], new_end)
        if grown:
            full = gops.make_axis(self.spark, ends["first"], new_end, self.spec)
            extra = full.where(F.col("time") > ta.ntz(ends["last"]))
            extra.select("time_idx", "time", "time_chunk").write.mode("append").parquet(f"{self.path}/axis")
        # also after a run that was lost between the two writes
        n_steps = int((new_end - ends["first"]).total_seconds() // self.spec.step_seconds) + 1
        if n_steps != self.n_steps:
            self.meta["n_steps"] = self.n_steps = n_steps
            self._save_meta()
        return grown

    # ------------------------------------------------------------------ JB07
    def info(self) -> DataFrame:
        """Base date, first/last time with their chunk and its range, partial flag."""
        spec = self.spec
        ext = self.axis().agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"))
        fc, lc = ta.chunk_index("first_time", spec), ta.chunk_index("last_time", spec)
        return ext.select(
            F.lit(spec.base_literal).alias("base_date"), "first_time",
            fc.alias("first_chunk"), ta.chunk_start(fc, spec).alias("first_chunk_start"),
            ta.chunk_end(fc, spec).alias("first_chunk_end"), "last_time",
            lc.alias("last_chunk"), ta.chunk_start(lc, spec).alias("last_chunk_start"),
            ta.chunk_end(lc, spec).alias("last_chunk_end"),
            ta.partial_chunk("last_time", spec).alias("partial_last_chunk"))
