"""Statistics kept with a grid store: one mergeable summary a chunk, year and cell.

``summary/time_chunk=<n>`` holds, per variable, the least and largest value, the number
of values and a bitmap of the steps that have one.  Checks merge these rows (minimum,
maximum, sum, bit operations) instead of scanning the grid, which has a row a step.

A summary names the files it was made from (a digest of their names; every write gives
new ones).  One whose files are no longer those of the chunk is stale, whoever wrote or
however a job was lost in between: that chunk, and no other, is scanned.
"""

from __future__ import annotations

import hashlib
import os
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timeaxis as ta

#: Steps in one word of a bitmap (the sign bit stays free).
WORD = 63
FIELDS = ("lo", "hi", "n", "bits")


def file_digests(store, chunks=None) -> dict[int, str]:
    """Digest of the file names of each time chunk (a scan's file index; no data is read)."""
    names: dict[int, list[str]] = {}
    for f in store.spark.read.schema(store.schema).parquet(f"{store.path}/grid").inputFiles():
        m = re.search(r"/time_chunk=(-?\d+)/", f)
        if m and (chunks is None or int(m[1]) in chunks):
            names.setdefault(int(m[1]), []).append(os.path.basename(f))
    return {c: hashlib.sha256("\n".join(sorted(n)).encode()).hexdigest() for c, n in names.items()}


def summarise(grid: DataFrame, store, variables=None) -> DataFrame:
    """Summary rows of a grid frame that has ``time_chunk``: one a chunk, year and cell."""
    spec, variables = store.spec, variables or store.variables
    step = F.pmod(ta.steps_since("time", spec.base_date, spec.step_seconds), F.lit(spec.plan.time)).cast("int")
    aggs = []
    for v in variables:
        bits = [F.coalesce(F.bit_or(F.when(F.col(v).isNotNull() & ((F.col("_step") / WORD).cast("int") == w),
                                           F.expr(f"shiftleft(1L, _step % {WORD})"))), F.lit(0).cast("long"))
                for w in range(-(-spec.plan.time // WORD))]
        aggs += [F.min(v).alias(f"lo__{v}"), F.max(v).alias(f"hi__{v}"), F.count(v).alias(f"n__{v}"), F.array(*bits).alias(f"bits__{v}")]
    return (grid.withColumn("_step", step).groupBy("time_chunk", F.year("time").alias("year"), "y", "x").agg(*aggs))


def write_summaries(store, chunks) -> None:
    """Makes or renews the summaries of the given time chunks from what the store holds."""
    digests = file_digests(store, set(chunks))
    if not digests:
        return
    names = store.spark.createDataFrame(sorted(digests.items()), "time_chunk int, files string")    # one row a chunk
    grid = store.read(with_chunks=True).where(F.col("time_chunk").isin(sorted(digests)))
    rows = summarise(grid, store).join(F.broadcast(names), "time_chunk")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("time_chunk").parquet(f"{store.path}/summary"))


def _schema(store) -> str:
    fields = [f"`lo__{v}` double, `hi__{v}` double, `n__{v}` bigint, `bits__{v}` array<bigint>" for v in store.variables]
    return ", ".join(["year int", "y int", "x int", *fields, "files string", "time_chunk int"])


def current_summaries(store, variables=None) -> DataFrame:
    """Summary rows of the whole store: kept ones, and those of chunks without a current one made on the way.

    Which chunks have one is known from two small lists (a row a chunk each) before the
    plan is made: without a stale chunk there is no scan of the grid in it."""
    variables = list(variables or store.variables)
    digests = file_digests(store)
    kept = store.spark.read.schema(_schema(store)).parquet(f"{store.path}/summary")
    known = {(r["time_chunk"], r["files"]) for r in kept.select("time_chunk", "files").distinct().collect()}
    fresh = sorted(c for c, f in digests.items() if (c, f) in known)
    stale = sorted(set(digests) - set(fresh))
    columns = ["time_chunk", "year", "y", "x", *[f"{f}__{v}" for v in variables for f in FIELDS]]
    rows = kept.where(F.col("time_chunk").isin(fresh)).select(columns)
    if stale:
        grid = store.read(variables, with_chunks=True).where(F.col("time_chunk").isin(stale))
        rows = rows.unionByName(summarise(grid, store, variables).select(columns))
    return rows


def incomplete_steps(store, variables=None) -> DataFrame:
    """``variable, time``: the steps of the store's axis at which some cell has no value.

    From the bitmaps alone: the conjunction over a chunk's cells says which steps all of
    its cells have.  A chunk in which some cell has no row misses them all."""
    variables = list(variables or store.variables)
    words = -(-store.spec.plan.time // WORD)
    # a chunk that spans two years has a row for each
    cells = current_summaries(store, variables).groupBy("time_chunk", "y", "x").agg(
        *[F.bit_or(F.get(f"bits__{v}", F.lit(w))).alias(f"{v}__{w}") for v in variables for w in range(words)])
    whole = cells.groupBy("time_chunk").agg(F.count("*").alias("_cells"), *[
        F.array(*[F.bit_and(f"{v}__{w}") for w in range(words)]).alias(v) for v in variables])
    spec = store.spec
    step = F.pmod(ta.steps_since("time", spec.base_date, spec.step_seconds), F.lit(spec.plan.time)).cast("int")
    axis = store.axis().select("time", "time_chunk", step.alias("_step"),
                               F.explode(F.array(*[F.lit(v) for v in variables])).alias("variable"))
    word = F.get(F.element_at(F.create_map(*[x for v in variables for x in (F.lit(v), F.col(v))]), F.col("variable")), F.expr(f"_step div {WORD}").cast("int"))
    has = (F.col("_cells") == store.n_cells()) & (F.expr(f"shiftright(_word, _step % {WORD}) & 1") == 1)
    return (axis.join(whole, "time_chunk", "left").withColumn("_word", word)
            .where(~F.coalesce(has, F.lit(False))).select("variable", "time"))
