"""Uniform shuffle of a table into shards of exact size (native).

The method draws a communication matrix: with input blocks of ``n_b`` rows and
shards of fixed capacity, the number of rows that block ``b`` sends to each shard
follows a multivariate hypergeometric law given what earlier blocks sent.  Rows
are permuted inside their block, dealt to shards by the block's row of the
matrix, exchanged, and permuted again inside the shard.  The result is a uniform
random permutation cut into shards whose row counts differ by at most one.

Whole rows are shuffled; no task holds a whole shard.  The matrix has at most ``MAX_BLOCKS`` x shards entries: block counts are
the only rows that reach the driver.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialise
from .registry import register

#: Most blocks (rows of the communication matrix), whatever the input size.
MAX_BLOCKS = 4096
#: Rows of a shard that one task permutes in the second local permutation.
ROWS_PER_BIN = 2_000_000


def hypergeometric(rng: random.Random, good: int, total: int, draws: int) -> int:
    """How many of ``draws`` rows taken from ``total`` belong to the ``good`` ones.

    Inversion outwards from the mode: exact for any counts, in about one standard
    deviation of steps."""
    low, high = max(0, draws - (total - good)), min(good, draws)
    if low >= high:
        return low
    bad = total - good

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(total, draws))
    u = rng.random() - at_mode
    up, p_up, down, p_down = mode, at_mode, mode, at_mode
    while u > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode


def communication_matrix(block_rows: list[int], capacities: list[int], seed: int) -> list[list[int]]:
    """Rows that each block sends to each shard; row sums and column sums are exact."""
    rng, left = random.Random(seed), list(capacities)
    matrix = []
    for n in block_rows:
        row, pool, need = [], sum(left), n
        for c in left:
            k = hypergeometric(rng, c, pool, need)
            row.append(k)
            pool, need = pool - c, need - k
        left = [c - k for c, k in zip(left, row, strict=True)]
        matrix.append(row)
    return matrix


def shuffle_into_shards(rows: DataFrame, n_shards: int, seed: int = 0, shard: str = "shard",
                        slot: str = "slot", max_blocks: int = MAX_BLOCKS,
                        rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """``rows`` with two more columns: ``shard`` (0 .. n_shards-1) and ``slot`` (gapless from 0).

    Shard sizes differ by at most one row.  Every row takes part whatever its
    values: nulls, repeated rows and ties are told apart by a row number written
    with the staged table, which also makes later passes repeatable.  An empty
    table gives no rows.  Input columns named like the outputs give way to them."""
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c.lower() not in (shard.lower(), slot.lower())]
    staged = materialise(rows.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_rid")), "shards")
    # the upper bits of the row number name the partition that wrote the row
    staged = staged.withColumn("_block", F.pmod(F.shiftright("_rid", 33), F.lit(max_blocks)).cast("int"))
    counted = sorted((r["_block"], r["n"]) for r in staged.groupBy("_block").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in counted)
    capacities = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix([n for _, n in counted], capacities, seed)
    cuts = []
    for (b, _), row in zip(counted, matrix, strict=True):
        ends, at = [], 0
        for k in row:
            at += k
            ends.append(at)
        cuts.append({"_block": b, "_cut": ends})
    deal = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(cuts)), "array<struct<_block:int,_cut:array<bigint>>>")))

    inside = Window.partitionBy("_block").orderBy(F.xxhash64(F.lit(seed), F.lit("first"), "_rid"), "_rid")
    dealt = (staged.withColumn("_rank", F.row_number().over(inside).cast("long") - 1)
             .join(F.broadcast(deal), "_block")  # at most max_blocks rows of n_shards numbers
             .withColumn(shard, F.size(F.filter("_cut", lambda end: end <= F.col("_rank"))))
             .drop("_cut", "_block", "_rank"))
    n_bins = max(1, math.ceil(total / n_shards / rows_per_bin))
    dealt = materialise(dealt.withColumn("_bin", F.pmod(F.xxhash64(F.lit(seed), F.lit("bin"), "_rid"), F.lit(n_bins)).cast("int")), "dealt")
    sizes = dealt.groupBy(shard, "_bin").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(shard, "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    again = Window.partitionBy(shard, "_bin").orderBy(F.xxhash64(F.lit(seed), F.lit("second"), "_rid"), "_rid")
    return (dealt.withColumn(slot, F.row_number().over(again).cast("long") - 1)
            .join(bases, [shard, "_bin"])
            .withColumn(slot, F.col(slot) + F.col("_base"))
            .select(*[F.col("_row").getField(c).alias(c) for c in kept], shard, slot))


@register("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by at most one (law ``rows``).

    The texts themselves go into the shards.  ``size`` is a shard row's UTF-8 bytes
    plus 8 (null: 8) and ``text_crc32`` its CRC-32 (null: that of the empty text)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    return shuffle_into_shards(docs, 24, seed=9).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
