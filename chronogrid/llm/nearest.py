"""Approximate nearest neighbours by cross-polytope hashing.

A vector is turned by fast pseudo-rotations (random signs and a Hadamard transform,
three times) and falls into the bucket of the signed axis nearest to it.  Every
table has rotations of its own.  A query looks into the buckets of its nearest axes
in each table, and all vectors it meets are reranked by their exact cosine.

Equal vectors are one class, indexed and searched once.  Buckets are cut into blocks
of bounded size, for candidates and queries alike, so a frequent bucket spreads over
tasks; a block returns the best of its candidates for each query, never all pairs.

How well buckets find neighbours depends on the vectors: near-random ones of many
dimensions meet too seldom.  So the recall of some queries is measured against all rows;
where it is below ``LEAST_RECALL``, and for queries that met fewer rows than asked for,
the same blocks hold all vectors of a length instead of those of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..operators.joins import size_checked_broadcast
from ..session import materialise
from .arrow import with_arrow_columns
from .registry import register

#: Tables of the index (copies of it that are shuffled) and axes probed in each.
TABLES, PROBES = 4, 32
#: Most candidates and queries of a block, as dealt by a hash.
BLOCK_CANDIDATES, BLOCK_QUERIES = 8192, 2048
#: Queries of a block that are compared at a time: 16 MB of products.
SLICE = 256
ROTATIONS = 3
#: Queries of each length whose recall is measured against all rows (those of the lowest hashes), and what it must reach.
MEASURED, LEAST_RECALL = 64, 0.9


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows (their length a power of two), orthonormal."""
    n, h = x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), -1, 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def turned(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """The rows after the table's pseudo-rotations, padded with zeros to a power of two."""
    n = 1 << (x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), n))
    y[:, :x.shape[1]] = x
    signs = np.random.default_rng([seed, table, n]).choice([-1.0, 1.0], (ROTATIONS, n))
    for s in signs:
        y = hadamard(y * s)
    return y


def signed_axes(x: np.ndarray, table: int, seed: int, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, the nearest first."""
    y = turned(x, table, seed)
    both = np.concatenate([y, -y], axis=1)
    probes = min(probes, both.shape[1])
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def vectors(column: pa.Array) -> list[np.ndarray]:
    """Rows of a binary column of doubles."""
    return [np.frombuffer(v.as_py()) for v in column]


def with_buckets(df: DataFrame, name: str, tables: int, probes: int, seed: int) -> DataFrame:
    """Adds the buckets (table, then axis) of the vector column ``vec`` as one array of numbers."""
    def start():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            rows, out = vectors(batch.column("vec")), [None] * batch.num_rows
            for size in {len(r) for r in rows}:
                at = [i for i, r in enumerate(rows) if len(r) == size]
                x = np.stack([rows[i] for i in at])
                x = x / np.abs(x).max(axis=1, keepdims=True)
                keys = np.concatenate([(t << 32) + signed_axes(x, t, seed, probes) for t in range(tables)], axis=1)
                for i, k in zip(at, keys):
                    out[i] = k
            return [pa.array(out, pa.list_(pa.int64()))]
        return compute
    return with_arrow_columns(df, start, [(name, T.ArrayType(T.LongType()))])


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled by their largest component, and their lengths: no overflow of squares."""
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled, np.sqrt((scaled * scaled).sum(axis=1))


def best_of_block(found: int):
    """Function of a block's queries and candidates that returns the best ids of each query."""
    def run(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        schema = pa.schema([("cls", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        q, q_len = unit(np.stack(vectors(queries.column("vec"))))
        c, c_len = unit(np.stack(vectors(candidates.column("vec"))))
        ids = candidates.column("ids").to_pylist()
        least = np.array([i[0] for i in ids])
        out = []
        keep = min(4 * found, len(c))
        for k, cls in enumerate(queries.column("cls").to_pylist()):
            if k % SLICE == 0:
                near = (q[k:k + SLICE] @ c.T) / c_len
            # the matrix product picks, one fixed order of summing scores
            row = near[k % SLICE] / q_len[k]
            top = np.argpartition(-row, keep - 1)[:keep]
            tied = np.flatnonzero(row >= row[top].min() - 1e-12)
            top = tied[np.lexsort((least[tied], -row[tied]))][:keep]
            scores = (c[top] * q[k]).sum(axis=1) / (c_len[top] * q_len[k])
            rows = sorted((-s, i) for s, t in zip(scores.tolist(), top) for i in ids[t])[:found]
            out += [(cls, i, -s) for s, i in rows]
        return pa.Table.from_arrays([pa.array(x) for x in zip(*out)], schema=schema)
    return run


def nearest_neighbours(rows: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                       tables: int = TABLES, probes: int = PROBES, seed: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows found for each query.

    ``is_query`` is a condition on the id; candidates are all rows but the query's
    own id.  Vectors that are null, empty, zero or hold null or non-finite components
    and rows without an id take no part.  Vectors of another length than the query's
    are no candidates.  Equal scores rank by id; a repeated id counts once, by its
    best score.  Fewer candidates than ``k`` are all returned, nearest first."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull()).select("vec_id", F.col("v").alias(vec_col)).where(
        finite & F.exists(vec_col, lambda x: x != 0)).withColumnRenamed(vec_col, "v")
    found = k + 1
    # of equal vectors the smallest ids are all that can rank; the limit acts before the shuffle
    ranked = valid.distinct().withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= found)
    classes = ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = classes.withColumn("cls", F.element_at("ids", 1))
    asked = valid.where(is_query(F.col("vec_id"))).distinct().join(classes.select("v", "cls"), "v")
    classes = materialise(_packed(classes.select("cls", "ids", "v")), "vectors")
    asked = materialise(asked.select(F.col("vec_id").alias("query_id"), "cls"), "queries")

    index = with_buckets(classes, "keys", tables, 1, seed).select("cls", "ids", "vec", F.explode("keys").alias("key"))
    query_classes = classes.join(asked.select("cls").distinct(), "cls", "left_semi").select("cls", "vec")
    probing = with_buckets(query_classes, "keys", tables, probes, seed).select("cls", "vec", F.explode("keys").alias("key"))
    size = (F.octet_length("vec") / 8).cast("int").alias("dim")
    index, probing, asked = index.select("*", size), probing.select("*", size), materialise(
        asked.join(query_classes.select("cls", size), "cls"), "queries")
    answer = materialise(_answers(asked, _best(index, probing, found, seed), found, k), "nearest")

    # what the buckets miss: of whole lengths, by measure; of single queries, by count
    whole = classes.select("cls", "ids", "vec", F.lit(0).cast("long").alias("key"), size)

    def exact(some: DataFrame) -> DataFrame:
        these = query_classes.join(some.select("cls").distinct(), "cls", "left_semi").select("cls", "vec", F.lit(0).cast("long").alias("key"), size)
        return _answers(some, _best(whole, materialise(these, "asked"), found, seed), found, k)

    some = (asked.withColumn("n", F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64(F.lit(seed), "query_id"), "query_id")))
            .where(F.col("n") <= MEASURED).drop("n"))
    wanted = materialise(exact(some), "measured").join(some.select("query_id", "dim"), "query_id")
    recall = (wanted.join(answer.select("query_id", "vec_id", F.lit(1).alias("met")), ["query_id", "vec_id"], "left")
              .groupBy("dim").agg(F.count("*").alias("n"), F.count("met").alias("met")))
    poor = [r["dim"] for r in recall.where(F.col("met") < LEAST_RECALL * F.col("n")).collect()]     # one row a length
    met = answer.groupBy("query_id").agg(F.count("*").alias("n"))
    again = asked.join(met, "query_id", "left").where(F.col("dim").isin(poor) | F.coalesce(F.col("n") < k, F.lit(True))).drop("n")
    again = materialise(again, "again")
    if not again.limit(1).count():
        return answer
    return answer.join(again.select("query_id"), "query_id", "left_anti").unionByName(exact(again))


def _best(index: DataFrame, probing: DataFrame, found: int, seed: int) -> DataFrame:
    """``cls, vec_id, score``: the ``found`` best candidates of each query in every block of ``key, dim``."""
    counts = (index.groupBy("key", "dim").agg(F.count("*").alias("n"))
              .join(probing.groupBy("key", "dim").agg(F.count("*").alias("m")), ["key", "dim"])
              .select("key", "dim", F.ceil(F.col("n") / BLOCK_CANDIDATES).cast("int").alias("cuts"),
                      F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("parts")))
    # one row a bucket at most (tables x axes x 2 for each length): a frequent one is cut where its rows are read
    counts = size_checked_broadcast(materialise(counts, "buckets"), 48)
    cut = F.pmod(F.xxhash64(F.lit(seed), "cls"), F.col("cuts")).cast("int")
    part = F.pmod(F.xxhash64(F.lit(seed), "cls"), F.col("parts")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = ["key", "dim", "cut", "part"]
    dealt = index.join(counts, ["key", "dim"]).select("key", "dim", cut.alias("cut"), every("parts").alias("part"), "ids", "vec")
    asking = probing.join(counts, ["key", "dim"]).select("key", "dim", every("cuts").alias("cut"), part.alias("part"), "cls", "vec")
    return (asking.groupBy(*place).cogroup(dealt.groupBy(*place))
            .applyInArrow(best_of_block(found), "cls long, vec_id long, score double"))


def _answers(asked: DataFrame, best: DataFrame, found: int, k: int) -> DataFrame:
    """The ``k`` nearest rows of each query from the best of all blocks."""
    ranked = (best.groupBy("cls", "vec_id").agg(F.max("score").alias("score"))
              .withColumn("n", F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("score"), "vec_id")))
              .where(F.col("n") <= found).drop("n"))
    answer = asked.join(ranked, "cls").where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (answer.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _packed(classes: DataFrame) -> DataFrame:
    """The array column ``v`` as a binary column ``vec`` of doubles."""
    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            v = b.column("v")
            flat, offsets = v.flatten().to_numpy(zero_copy_only=False).astype("<f8"), v.offsets.to_numpy()
            offsets = offsets - offsets[0]
            packed = [flat[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("ids"), pa.array(packed, pa.binary())], names=["cls", "ids", "vec"])
    return classes.mapInArrow(run, "cls long, ids array<long>, vec binary")


@register("op5_nearest")
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for every 50th id, searched among all vectors."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest_neighbours(rows, lambda i: F.pmod(i, F.lit(50)) == 0)
