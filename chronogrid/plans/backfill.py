"""Restartable backfills: a progress table says which chunks are done, and from what input.

``progress/`` of the target store has a row a finished chunk: its number, a digest of the
input it was made from, and when.  A run takes the chunks whose latest digest isn't that
of today's input (all others are anti-joined away), a few at a time; a chunk's row is
written after the chunk.  So a run that ends half way goes on with the chunks left, and
input that changed since is processed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..config import GridSpec, parse_base_date
from ..sources import hourly_files, manifest
from ..sources.gridstore import GridStore
from ..sources.summaries import file_digests
from . import daily as daily_jobs
from . import hourly as hourly_jobs

PROGRESS = "job string, chunk int, input string, finished timestamp_ntz"


def progress(store: GridStore) -> DataFrame:
    """All progress rows of a store."""
    path = f"{store.path}/progress"
    store.spark.createDataFrame([], PROGRESS).write.mode("append").parquet(path)     # there from the first look on
    return store.spark.read.schema(PROGRESS).parquet(path)


def chunks_left(store: GridStore, job: str, inputs: DataFrame) -> DataFrame:
    """Rows of ``inputs(chunk, input)`` that aren't done: never, or from other input last time."""
    latest = (progress(store).where(F.col("job") == job)
              .withColumn("_n", F.row_number().over(Window.partitionBy("chunk").orderBy(F.col("finished").desc()))).where("_n = 1"))
    return inputs.join(latest.select("chunk", "input"), ["chunk", "input"], "left_anti")


def mark_done(store: GridStore, job: str, inputs: DataFrame) -> None:
    rows = inputs.select(F.lit(job).alias("job"), "chunk", "input", F.localtimestamp().alias("finished"))
    rows.coalesce(1).write.mode("append").parquet(f"{store.path}/progress")


def _runs(chunks: list[int], at_a_time: int) -> list[tuple[int, int]]:
    """Neighbouring chunks together, ``at_a_time`` at most."""
    runs: list[tuple[int, int]] = []
    for c in sorted(chunks):
        if runs and runs[-1][1] == c - 1 and c - runs[-1][0] < at_a_time:
            runs[-1] = runs[-1][0], c
        else:
            runs.append((c, c))
    return runs


def _run(store: GridStore, job: str, inputs: DataFrame, at_a_time: int, process, most: int | None) -> list[int]:
    left = {r["chunk"]: r["input"] for r in chunks_left(store, job, inputs).collect()}    # one row a chunk
    done: list[int] = []
    for first, last in _runs(list(left), at_a_time)[:most]:
        process(first, last)
        some = list(range(first, last + 1))
        mark_done(store, job, store.spark.createDataFrame([(c, left[c]) for c in some], "chunk int, input string"))
        done += some
    return done


# --- JB12 / JB04: days from a stored hourly grid ------------------------------
def daily_inputs(hourly: GridStore, spec: GridSpec, first: int, last: int) -> DataFrame:
    """``chunk, input`` of daily chunks: a digest of the files of the hourly chunks that their days lie in."""
    digests, start, rows = file_digests(hourly), parse_base_date(hourly.axis_start), []
    for c in range(first, last + 1):
        begin, end = daily_jobs.daily_chunk_hours(spec, start, c, c)
        if end < begin:
            continue
        span = [int((t - hourly.spec.base).total_seconds() // hourly.spec.chunk_seconds) for t in (begin, end)]
        made_of = [f"{k}={digests[k]}" for k in range(span[0], span[1] + 1) if k in digests]
        if made_of:
            rows.append((c, ",".join(made_of)))
    frame = hourly.spark.createDataFrame(rows, "chunk int, input string")
    return frame.select("chunk", F.sha2("input", 256).alias("input"))


def backfill_daily(hourly: GridStore, daily: GridStore, first: int, last: int, at_a_time: int = 16, most_runs: int | None = None) -> list[int]:
    """JB12, restartable: days of the daily chunks ``first..last`` that have new input; returns the chunks done.

    ``most_runs`` ends it early (a time slice of a job array)."""
    return _run(daily, "daily", daily_inputs(hourly, daily.spec, first, last), at_a_time,
                lambda a, b: daily_jobs.process_daily(hourly, daily, a, b), most_runs)


# --- JB12 / JB02: hours from files ---------------------------------------------
def hourly_inputs(spark, spec: GridSpec, first: int, last: int, wrf_dir: str, template: str) -> DataFrame:
    """``chunk, input`` of hourly chunks: a digest of the names, sizes and times of their files (one row a file, in Spark)."""
    chunks = spark.range(first, last + 1).select(F.col("id").cast("int").alias("chunk"))
    files = hourly_files.file_stamps(spark, wrf_dir)
    found = manifest.verified_manifest(manifest.hourly_manifest(chunks, spec, wrf_dir, template), files.select("path").distinct(), wrf_dir, template)
    return (found.select("chunk", "path").join(files, "path")
            .groupBy("chunk").agg(F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws("|", "path", "stamp"))), ","), 256).alias("input")))


def backfill_hourly(spark, store: GridStore, first: int, last: int, wrf_dir: str, template: str, files: hourly_jobs.HourlyInput,
                    at_a_time: int = 16, most_runs: int | None = None) -> list[int]:
    """JB02 / JB12 from files, restartable: chunks whose files are new or changed; returns the chunks done."""
    def process(a: int, b: int) -> None:
        hourly_jobs.process_hourly_files(spark, store, a, b, wrf_dir, template, files, listing=hourly_files.list_files(spark, wrf_dir))
    return _run(store, "hourly", hourly_inputs(spark, store.spec, first, last, wrf_dir, template), at_a_time, process, most_runs)


def progress_report(store: GridStore) -> DataFrame:
    """Per job and chunk: how often it was processed and when last."""
    return progress(store).groupBy("job", "chunk").agg(F.count("*").alias("runs"), F.max("finished").alias("finished"))
