"""SR03 hourly_scan: many hourly files read as one grid.

Hourly files are Parquet (one dataset per hour: rows ``(time, y, x, vars...,
constants...)``).  The file list comes from a (verified) manifest; its order
is the time order, made explicit by ``time``."""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import GridSpec
from ..functions import timeaxis as ta
from ..functions.values import mask_missing
from ..operators.grid import KEYS
from ..operators.joins import size_checked_broadcast


def hourly_schema(variables, constants=()) -> T.StructType:
    fields = [T.StructField("time", T.TimestampNTZType()), T.StructField("y", T.IntegerType()),
              T.StructField("x", T.IntegerType())]
    fields += [T.StructField(v, T.DoubleType()) for v in variables]
    fields += [T.StructField(c, T.DoubleType()) for c in constants]
    return T.StructType(fields)


def write_hourly_files(df: DataFrame, root: str, wy_col: str = "wy_dir", name_col: str = "fname",
                       n_writers: int | None = None) -> None:
    """Write one dataset per hour under ``root/wy_dir=<WY>/fname=<name>``.

    Range partitioning with an explicit writer count keeps every hour in one
    task (one file per hour) while all writers work in parallel; a hash
    repartition would be coalesced by AQE into very few writers on small data."""
    n = n_writers or df.sparkSession.sparkContext.defaultParallelism
    (df.repartitionByRange(n, wy_col, name_col).sortWithinPartitions(wy_col, name_col)
     .write.mode("overwrite").partitionBy(wy_col, name_col).parquet(root))


def plain_path(path) -> F.Column:
    """A path as manifests write it: local ones without their scheme."""
    return F.regexp_replace(path, "^file:/+", "/")


def folder_of(path) -> F.Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths of the hourly datasets under ``root`` (folders of data files), from Spark's file index."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(folder_of(plain_path(F.col("path"))).alias("path")).distinct()


def file_stamps(spark: SparkSession, root: str) -> DataFrame:
    """``path, stamp``: the hourly datasets under ``root``, each data file with its name, size and time of change."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    stamp = F.concat_ws(":", F.regexp_extract("path", "[^/]*$", 0), F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    return files.select(folder_of(plain_path(F.col("path"))).alias("path"), stamp.alias("stamp"))


def year_folders(template: str, wrf_dir: str, first: _dt.datetime, last: _dt.datetime) -> str:
    """Glob of the water-year folders that files of ``first..last`` may lie in (October 1 also a year early)."""
    years = range(first.year, last.year + 2)
    head, _, tail = template.partition("{wy_dir}")
    folder = head + "{" + ",".join(f"WY{y}" for y in years) + "}" + tail.partition("/")[0]
    return folder.replace("{wrf_dir}", wrf_dir)


# Directives from the longest period to the shortest.
_BIG_ENDIAN = "YmdHMS"


def path_range(template: str, wrf_dir: str, first: _dt.datetime, last: _dt.datetime) -> F.Column | None:
    """Predicate on ``_metadata.file_path``: the paths that the template gives times ``first..last``.

    Where the template writes its dates from the year down, paths of one folder ascend with
    time, so a water year is one range of texts, however many files it has; Spark's file
    listing applies it before a file is opened.  Other templates give no predicate."""
    written = re.findall(r"%(.)", "".join(re.findall(r"\{fdate:([^}]*)\}", template)))
    at = [_BIG_ENDIAN.find(d) for d in written]
    if not at or -1 in at or at != sorted(at) or at[0] != 0:
        return None

    def path(wy: int, t: _dt.datetime) -> str:
        filled = template.replace("{wrf_dir}", wrf_dir).replace("{wy_dir}", f"WY{wy}")
        return re.sub(r"\{fdate:([^}]*)\}", lambda m: t.strftime(m[1]), filled)
    place = plain_path(F.col("_metadata.file_path"))
    ranges = [(place >= plain_text(path(wy, first))) & (place <= plain_text(path(wy, last)) + "\uffff") for wy in range(first.year, last.year + 2)]
    return reduce(lambda a, b: a | b, ranges)


def plain_text(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def scan_manifest(spark: SparkSession, manifest: DataFrame, spec: GridSpec, first_chunk: int, last_chunk: int,
                  wrf_dir: str, template: str, variables, constants=()) -> tuple[DataFrame, DataFrame]:
    """SR03 within the plan: the rows of the files in ``manifest(path)``, and the constants per cell.

    The folders of the chunks' water years are one scan, whose listing keeps only paths
    within the chunks' time range; the range is also pushed to the files, and rows of
    files that the manifest lacks are dropped by a join on the path.  No path reaches the
    driver, however many files there are."""
    first = spec.base + _dt.timedelta(seconds=first_chunk * spec.chunk_seconds)
    end = spec.base + _dt.timedelta(seconds=(last_chunk + 1) * spec.chunk_seconds)
    schema = hourly_schema(variables, constants)
    df = (spark.read.schema(schema).option("mergeSchema", "false").option("recursiveFileLookup", "true")
          .parquet(year_folders(template, wrf_dir, first, end)))
    path = plain_path(F.col("_metadata.file_path"))
    inside = path_range(template, wrf_dir, first, end - _dt.timedelta(seconds=1))
    if inside is not None:
        df = df.where(inside)
    df = df.where((F.col("time") >= ta.ntz(first)) & (F.col("time") < ta.ntz(end))).select(
        *schema.names, (path if template.endswith(".parquet") else folder_of(path)).alias("path"))
    wanted = manifest.select(plain_path(F.col("path")).alias("path"))
    # one path an hour of the chunks asked for
    hours = (last_chunk - first_chunk + 1) * spec.plan.time
    df = df.join(size_checked_broadcast(wanted, 256, n_rows=hours), "path", "left_semi")
    return _split(df, variables, constants)


def load_hourly_files(spark: SparkSession, paths: list[str], variables, constants=()) -> tuple[DataFrame, DataFrame]:
    """Time-varying rows from all ``paths`` (explicit schema, no schema merge)
    and the constant variables per cell.

    Constants repeat in every file; each cell takes them from the earliest
    file holding that cell, which is the first file when files are dense and
    still complete when hourly files are sparse.  Only the key and constant
    columns are read for this, and the aggregation is partial before its
    shuffle."""
    if not paths:
        raise ValueError("no hourly files")
    schema = hourly_schema(variables, constants)
    return _split(spark.read.schema(schema).option("mergeSchema", "false").parquet(*paths), variables, constants)


def _split(df: DataFrame, variables, constants) -> tuple[DataFrame, DataFrame]:
    grid = mask_missing(df.select(*KEYS, *variables), variables)
    if not constants:
        return grid, df.select("y", "x").distinct()
    first = F.min_by(F.struct(*[F.col(c) for c in constants]), F.col("time")).alias("_c")
    cells = df.groupBy("y", "x").agg(first).select("y", "x", "_c.*")
    return grid, cells
