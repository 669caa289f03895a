"""SimHash near-duplicates found through deletion-variant signatures.

A fingerprint of ``BITS`` bits is cut into ``(max_bits + 1) / 2`` segments,
rounded up: of two fingerprints that differ in at most ``max_bits`` bits, one
segment then differs in at most one bit.  Every fingerprint is indexed under each
of its segments with one bit left out (the wildcard), so linked fingerprints meet
under an equal key whatever that bit is, and the full distance is verified.

Only distinct fingerprints are indexed: copies never meet.  Fingerprints that
share a key arrive sorted by it and are reduced to the edges of a spanning forest,
so a large group of near copies yields a number of edges that grows with its
size, not with its square.  Classes are the connected components of all edges.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .arrow import texts_as_bytes, with_arrow_columns
from .components import connected_components
from .registry import register
from .worker import kept

BITS = 64
#: A-Z lower-cased; all other bytes, so all other letters, unchanged.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Members compared in one block, so the memory of a comparison is bounded.
BLOCK = 1024


def fingerprints(raw: bytes | None, words_per_shingle: int, seeds: tuple[int, ...] = (42,)) -> list[int]:
    """SimHash of the word shingles of a UTF-8 text, one for each seed (no words: 0)."""
    words = (raw or b"").translate(LOWER).split()  # bytes split at exactly 20 and 09-0D
    if not words:
        return [0] * len(seeds)
    k = min(words_per_shingle, len(words))
    n, digest = len(words) - k + 1, xxhash.xxh64_intdigest
    votes = np.zeros((len(seeds), BITS), np.int64)
    for at in range(0, n, 65536):
        part = words[at:at + 65536 + k - 1]
        shingles = list(map(b" ".join, zip(*(part[i:] for i in range(k)))))
        for v, seed in zip(votes, seeds):
            hashes = np.array([digest(s, seed) for s in shingles], ">u8")
            v += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return [int(np.packbits(2 * v > n).view(">i8")[0]) for v in votes]


def fingerprint(raw: bytes | None, words_per_shingle: int, seed: int = 42) -> int:
    return fingerprints(raw, words_per_shingle, (seed,))[0]


def with_fingerprint(docs: DataFrame, text_col: str = "text", words_per_shingle: int = 3,
                     names: tuple[str, ...] = ("fingerprint_bits",), without: tuple[str, ...] = (),
                     seeds: tuple[int, ...] = (42,)) -> DataFrame:
    """``docs`` plus fingerprints of each whole text as signed 64-bit numbers, a column for each seed."""
    def start():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = [fingerprints(t, words_per_shingle, seeds) for t in texts_as_bytes(batch, text_col)]
            return [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(seeds))]
        return compute
    return with_arrow_columns(docs, start, [(n, T.LongType()) for n in names], without)


def spanning_edges(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among fingerprints, as their positions.

    Smallest labels spread over linked members, one bounded block of comparisons
    at a time, until nothing changes: exact for any number of members."""
    m = len(prints)
    labels = np.arange(m)
    while True:
        old = labels.copy()
        for i in range(0, m, BLOCK):
            rows = slice(i, min(i + BLOCK, m))
            for j in range(0, m, BLOCK):
                cols = slice(j, min(j + BLOCK, m))
                near = np.bitwise_count(prints[rows, None] ^ prints[None, cols]) <= max_bits
                labels[rows] = np.minimum(labels[rows], np.where(near, labels[None, cols], m).min(axis=1))
        labels = labels[labels]
        if (labels == old).all():
            break
    tail = np.flatnonzero(labels != np.arange(m))
    return labels[tail], tail


def _edges_of_runs(batches: Iterable[pa.RecordBatch], max_bits: int, owner: str) -> Iterator[pa.RecordBatch]:
    """Edges between the nodes within each run of equal keys of a partition sorted by key.

    Without a column ``node`` a fingerprint is its own node."""
    kept(owner)
    held_key, held = None, []

    def edges(prints: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = spanning_edges(prints, max_bits)
        return nodes[a], nodes[b]

    def flush() -> tuple[np.ndarray, np.ndarray]:
        if not held:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        prints, nodes = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        return edges(prints, nodes)

    def out(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], names=["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, signed = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp"))
        nodes = batch.column("node").to_numpy(zero_copy_only=False) if "node" in batch.schema.names else signed
        prints = signed.view(np.uint64)
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[starts[1:], len(keys)]
        found = []
        if held and keys[0] == held_key:
            held.append((prints[:ends[0]].copy(), nodes[:ends[0]].copy()))
            starts, ends = starts[1:], ends[1:]
        if len(starts):
            found.append(flush())
            held_key, held = keys[starts[-1]], [(prints[starts[-1]:].copy(), nodes[starts[-1]:].copy())]
            starts, ends = starts[:-1], ends[:-1]
        size = ends - starts
        first = starts[size == 2]
        near = first[np.bitwise_count(prints[first] ^ prints[first + 1]) <= max_bits]
        found.append((nodes[near], nodes[near + 1]))
        for s, e in zip(starts[size > 2], ends[size > 2]):
            found.append(edges(prints[s:e], nodes[s:e]))
        if sum(len(f[0]) for f in found):
            yield out(found)
    if held:
        yield out([flush()])


def linked_classes(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """``fp, root`` of the distinct fingerprints ``fp`` (the first column) that link with another one.

    ``prints`` has a column of 64-bit fingerprints for each seed.  Rows link when the
    fingerprints of any one seed differ in at most ``max_bits`` bits (up to 7)."""
    segments = max(2, (max_bits + 2) // 2)
    width = BITS // segments
    distinct = materialise(prints.distinct(), "prints")
    wild = F.explode(F.sequence(F.lit(0), F.lit(segments * width - 1)))
    # the key: number of the seed and the wildcard position, then the segment with that bit cleared
    segment = F.expr(f"shiftrightunsigned(fp, p - p % {width}) & {(1 << width) - 1}L")
    variants = None
    for k, column in enumerate(prints.columns):
        key = F.expr(f"shiftleft(cast(p + {k * BITS} as bigint), {width}) | (seg & ~shiftleft(1L, p % {width}))").alias("key")
        # one column: the fingerprint is the node, and rows are narrower
        own = [F.col(column).alias("fp")] + ([F.col(prints.columns[0]).alias("node")] if len(prints.columns) > 1 else [])
        rows = distinct.select(*own) if k == 0 and len(own) == 1 else distinct.select(*own).distinct()
        rows = rows.select("*", wild.alias("p")).select("*", segment.alias("seg")).select(key, *rows.columns)
        variants = rows if variants is None else variants.unionByName(rows)
    owner = uuid.uuid4().hex
    edges = (variants.repartition("key").sortWithinPartitions("key")
             .mapInArrow(lambda batches: _edges_of_runs(batches, max_bits, owner), "u long, v long"))
    return connected_components(edges).select(F.col("node").alias("fp"), "root")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           words_per_shingle: int = 3, max_bits: int = 3, also: tuple[str, ...] = (),
                           seeds: tuple[int, ...] = (42,)) -> DataFrame:
    """``id_col``, the columns ``also``, ``fingerprint_bits, component_id`` of every row of ``docs``.

    ``component_id`` is the smallest id of the documents reachable over links, the
    document's own included.  Null and empty texts have fingerprint 0 and link like
    any other; texts of fewer words than a shingle are one shingle.  With several
    ``seeds`` the fingerprints of any one of them link; that of the first is returned.  Rows with a
    null id link too but give no id: a class of null ids only has a null
    ``component_id``.  Repeated rows each come back.  An empty table gives no rows."""
    names = ("fingerprint_bits", *(f"fingerprint_bits_{s}" for s in seeds[1:]))
    marked = materialise(with_fingerprint(docs.select(id_col, *also, text_col), text_col, words_per_shingle, names,
                                          (text_col,), seeds), "simhash")
    roots = linked_classes(marked.select(*names), max_bits)
    least = marked.groupBy("fingerprint_bits").agg(F.min(id_col).alias("_least"))
    # one row per distinct fingerprint from here to the last join
    rooted = (least.join(roots.withColumnRenamed("fp", "fingerprint_bits"), "fingerprint_bits", "left")
              .withColumn("root", F.coalesce("root", "fingerprint_bits")))
    ids = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(ids, "root").select("fingerprint_bits", "component_id")
    return marked.join(named, "fingerprint_bits").select(id_col, *also, "fingerprint_bits", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each class of near duplicates: that of the smallest id, whole and unchanged.

    Of rows that share that id too, one stays.  Rows with a null id can't be told
    apart by id and all stay.  ``how`` goes to ``near_duplicate_classes``."""
    marks = [F.xxhash64(F.lit(k), F.col(text_col)).alias(f"m{k}") for k in (1, 2)]
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *marks).where("id IS NOT NULL")
    classes = near_duplicate_classes(named, "id", "text", also=("m1", "m2"), **how)
    stay = (classes.where("id = component_id").groupBy("component_id").agg(F.min(F.struct("id", "m1", "m2")).alias("s"))
            .select("s.*"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), *marks)
    kept = rows.join(stay, ["id", "m1", "m2"], "left_semi").dropDuplicates(["id", "m1", "m2"])
    return kept.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))


@register("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document: 3-word shingles, links at 3 bits or fewer."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicate_classes(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint_bits"), 16, "0")).alias("fingerprint"), "component_id")
