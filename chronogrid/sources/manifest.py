"""Expected hourly file lists (manifests) and their check against a listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import GridSpec
from ..functions import timeaxis as ta

# Fixed value: default hourly file name pattern (the path template of the
# model output, with the date rendered as %Y%m%d%H%M).
DEFAULT_TEMPLATE = "{wrf_dir}/{wy_dir}/{fdate:%Y%m%d%H%M}.LDASIN_DOMAIN1"


# --- SR01 file_manifest -------------------------------------------------------
def hourly_manifest(chunks: DataFrame, spec: GridSpec, wrf_dir: str,
                    template: str = DEFAULT_TEMPLATE, chunk_col: str = "chunk") -> DataFrame:
    """Expected file of every hour of every chunk in ``chunks``.

    ``num_days`` days x 24 hours from the chunk start; the water-year directory
    comes from the *day* (``cdate``), the file name from the hour (``fdate``).
    Output ``(chunk, day, hour, fdate, path)``."""
    n_hours = spec.num_days * 24
    start = ta.chunk_start(F.col(chunk_col), spec)
    rows = chunks.select(F.col(chunk_col).alias("chunk"), start.alias("_start"),
                         F.explode(F.sequence(F.lit(0), F.lit(n_hours - 1))).alias("_k"))
    cdate = ta.add_interval("_start", days=F.floor(F.col("_k") / 24).cast("int"))
    rows = rows.select("chunk", cdate.alias("cdate"), (F.col("_k") % 24).cast("int").alias("hour"),
                       ta.add_interval("_start", hours=F.col("_k").cast("int")).alias("fdate"))
    return rows.select("chunk", "cdate", "hour", "fdate",
                       manifest_path(template, wrf_dir, ta.water_year_dir("cdate"), "fdate").alias("path"))


def manifest_path(template: str, wrf_dir: str, wy_dir, fdate) -> F.Column:
    """SC12: fill the path template from fixed fields only (no code evaluation)."""
    return ta.path_format(template, {"wrf_dir": F.lit(wrf_dir), "wy_dir": wy_dir,
                                     "fdate": F.col(fdate) if isinstance(fdate, str) else fdate})


# --- SR02 file_manifest_verified / JN04 manifest_existence --------------------
def verified_manifest(manifest: DataFrame, listing: DataFrame, wrf_dir: str,
                      template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """Keep the expected files that exist in ``listing(path)``.

    October 1 00h missing from its water-year directory: the file of the
    previous water-year directory is taken if it exists, and the remaining
    hours of that day are dropped (the reference stops the day there).  Any
    other missing file is skipped.

    An hour has one candidate path, on October 1 three (its own, that of the year
    before, and the first of the day): all meet the listing in one join, and what was
    found is put together per hour."""
    oct1 = (F.month("cdate") == 10) & (F.dayofmonth("cdate") == 1)
    alt_dir = F.concat(F.lit("WY"), F.year("cdate").cast("string"))
    day00 = ta.add_interval("cdate", hours=0)
    candidate = lambda kind, path: F.struct(F.lit(kind).alias("kind"), path.alias("path"))
    own = candidate("own", F.col("path"))
    boundary = F.array(own, candidate("alt", manifest_path(template, wrf_dir, alt_dir, "fdate")),
                       candidate("day00", manifest_path(template, wrf_dir, ta.water_year_dir("cdate"), day00)))
    found = (manifest.select("chunk", "fdate", "hour", oct1.alias("oct1"), F.explode(F.when(oct1, boundary).otherwise(F.array(own))).alias("c"))
             .select("chunk", "fdate", "hour", "oct1", "c.kind", "c.path")
             .join(listing.select("path"), "path", "left_semi"))
    of = {k: F.max(F.when(F.col("kind") == k, F.col("path"))) for k in ("own", "alt", "day00")}
    kept_path = (F.when(~F.col("oct1"), of["own"]).when(of["day00"].isNotNull(), of["own"])
                 .when(F.col("hour") == 0, of["alt"]))
    return (found.groupBy("chunk", "fdate", "hour", "oct1").agg(kept_path.alias("path"))
            .where("path IS NOT NULL").select("chunk", "fdate", "path"))


def existing_files(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """JN04: expected files that exist (left semi join on the path)."""
    return manifest.join(listing.select("path"), "path", "left_semi")


def manifest_report(manifest: DataFrame, kept: DataFrame) -> DataFrame:
    """Per chunk: files expected, files kept and files missing (the reference
    skips missing files silently; the count makes them visible)."""
    exp = manifest.groupBy("chunk").agg(F.count("*").alias("expected"))
    got = kept.groupBy("chunk").agg(F.count("*").alias("found"))
    return (exp.join(got, "chunk", "left")
            .select("chunk", "expected", F.coalesce(F.col("found"), F.lit(0)).alias("found"))
            .withColumn("missing", F.col("expected") - F.col("found")))
