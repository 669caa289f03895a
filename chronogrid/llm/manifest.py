"""Merkle manifest of a dataset: a hash tree a group, a tree of the groups' roots above, proofs folded from kept states.

Rows of a group ascend by id; every ``FAN`` consecutive nodes become one parent until
one node is left.  A parent is hashed child by child, and a copy of the hash state is
kept before each child's slot.  Folding a row's proof resumes at each level the state
before its slot with the (possibly changed) child and the siblings to the right only:
what lies to the left is never hashed again.

Trees are built and folded in subtrees of ``FAN ** LEVELS`` leaves: positions come from
a range sort, so a group of any size spreads over tasks, and a task holds one subtree.
Paths come down once a subtree, not once a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise
from .line_dedup import LOWER, UPPER
from .registry import register

#: Children of a parent.
FAN = 16
#: Levels of a subtree: it has FAN ** LEVELS leaves at most, about 0.5 MB with its rows.
LEVELS = 3
NODES = "_tree string, _pos bigint, _n bigint, _digest binary"
PATH = "array<struct<left:string,right:string>>"
PATHS = f"_tree string, _pos bigint, _path {PATH}, _subroot string, _root string"


def row_digest(columns: Iterable[Column]) -> Column:
    """SHA-256 (hex) of the columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in columns]).cast("binary"), 256)


class Parent:
    """A parent's digest, its children's digests in one text, and the hash state before each child's slot."""

    def __init__(self, children: list[bytes]):
        state = hashlib.sha256()
        self.before = []
        for child in children:
            self.before.append(state.copy())
            state.update(child)
        self.text, self.digest = b"".join(children), state.hexdigest().encode()

    def left(self, slot: int) -> bytes:
        return self.text[:64 * slot]

    def right(self, slot: int) -> bytes:
        return self.text[64 * slot + 64:]


def resume(before: Any, child: bytes, right: bytes) -> bytes:
    """The parent's digest with ``child`` in the slot whose state ``before`` was kept."""
    state = before.copy()
    state.update(child)
    state.update(right)
    return state.hexdigest().encode()


def subtree(nodes: list[bytes], total: int, height: int) -> list[list[Parent]]:
    """Parents of consecutive nodes, level by level: ``height`` of them, or fewer up to the single node of a tree
    whose ``total`` nodes are all here."""
    levels: list[list[Parent]] = []
    while total > 1 and len(levels) < height:
        levels.append([Parent(nodes[k:k + FAN]) for k in range(0, len(nodes), FAN)])
        nodes, total = [p.digest for p in levels[-1]], -(-total // FAN)
    return levels


def _hex(column: pa.ChunkedArray) -> list[bytes | None]:
    return [None if b is None else b.hex().encode() for b in column.to_pylist()]


def _climb(key: tuple, table: pa.Table, height: int) -> pa.Table:
    """The node that one subtree becomes."""
    table = table.sort_by("_pos")
    nodes, total = _hex(table["_digest"]), table["_n"][0].as_py()
    levels = subtree(nodes, total, height)
    top = levels[-1][0].digest if levels else nodes[0]
    return pa.table({"_tree": pa.array([key[0].as_py()], pa.string()), "_pos": pa.array([key[1].as_py()], pa.int64()),
                     "_n": pa.array([-(-total // FAN ** height)], pa.int64()), "_digest": pa.array([bytes.fromhex(top.decode())], pa.binary())})


def _positions(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` plus ``_pos`` (from 0, in ``order`` within ``_tree``) and ``_n`` (rows of the tree).

    A range sort numbers the rows of every partition; a tree's offsets are sums over the
    partitions it lies in, one row each."""
    keys = [F.col("_tree").asc(), *[F.col(c).asc_nulls_first() for c in order]]
    staged = materialise(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("_rid", F.monotonically_increasing_id()), name)
    staged = staged.withColumn("_part", F.shiftright("_rid", 33))
    runs = staged.groupBy("_tree", "_part").agg(F.min("_rid").alias("_first"), F.count("*").alias("_rows"))
    tree = Window.partitionBy("_tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_tree", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                       F.sum("_rows").over(tree).alias("_n"))
    return staged.join(runs, ["_tree", "_part"]).withColumn("_pos", F.col("_rid") + F.col("_shift")).drop("_rid", "_part", "_shift")


def _subtrees(nodes: DataFrame, height: int):
    return nodes.groupBy("_tree", F.expr(f"_pos div {FAN ** height}").alias("_chunk"))


def _rounds(leaves: DataFrame, height: int, name: str) -> list[DataFrame]:
    """Nodes at every ``height``-th level, the leaves first and the single nodes of all trees last."""
    rounds = [leaves.select("_tree", "_pos", "_n", "_digest")]
    while (rounds[-1].agg(F.max("_n")).first()[0] or 0) > 1:
        rounds.append(materialise(_subtrees(rounds[-1], height).applyInArrow(
            lambda key, table: _climb(key, table, height), NODES), name))
    return rounds


def _path_down(nodes: pa.Table, above: pa.Table, height: int) -> pa.Table:
    """The siblings of every node of one subtree up to its top, then those of the top itself."""
    nodes = nodes.sort_by("_pos")
    found, tail = _hex(nodes["_digest"]), above["_path"][0].as_py()
    levels = subtree(found, nodes["_n"][0].as_py(), height)
    paths = []
    for i in range(len(found)):
        path = []
        for parents in levels:
            i, slot = divmod(i, FAN)
            path.append({"left": parents[i].left(slot).decode(), "right": parents[i].right(slot).decode()})
        paths.append(path + tail)
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    return pa.table({"_tree": nodes["_tree"], "_pos": nodes["_pos"], "_path": pa.array(paths, kind),
                     **{c: pa.array([above[c][0].as_py()] * len(found), pa.string()) for c in ("_subroot", "_root")}})


def _descend(nodes: DataFrame, tops: DataFrame, height: int, name: str) -> DataFrame:
    """Paths of ``nodes`` from those of the nodes that their subtrees became."""
    return materialise(_subtrees(nodes, height).cogroup(tops.withColumnRenamed("_pos", "_chunk").groupBy("_tree", "_chunk"))
                       .applyInArrow(lambda rows, above: _path_down(rows, above, height), PATHS), name)


def _fold(rows: pa.Table, above: pa.Table, height: int) -> pa.Table:
    """Proof digest and folded root of every row of one subtree."""
    rows = rows.sort_by("_pos")
    nodes, changed = _hex(rows["_digest"]), _hex(rows["_changed"])
    levels = subtree(nodes, rows["_n"][0].as_py(), height)
    upper = [(hashlib.sha256(p["left"].encode()), p["left"].encode(), p["right"].encode()) for p in above["_path"][0].as_py()]
    proofs, folded = [], []
    for k, node in enumerate(nodes):
        proof, at, i = hashlib.sha256(), node if changed[k] is None else changed[k], k
        for parents in levels:
            i, slot = divmod(i, FAN)
            parent = parents[i]
            right = parent.right(slot)
            proof.update(parent.left(slot))
            proof.update(right)
            at = resume(parent.before[slot], at, right)
        for before, left, right in upper:
            proof.update(left)
            proof.update(right)
            at = resume(before, at, right)
        proofs.append(proof.hexdigest())
        folded.append(at.decode())
    return pa.table({"_id": rows["_id"], "leaf": pa.array([x.decode() for x in nodes], pa.string()),
                     **{c: pa.array([above[f"_{c}"][0].as_py()] * len(nodes), pa.string()) for c in ("subroot", "root")},
                     "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string())})


def merkle_manifest(rows: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source",
                    changed: dict[str, Column] | None = None, changed_where: Column | None = None,
                    height: int = LEVELS) -> DataFrame:
    """``id_col, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    A leaf is the digest of ``columns`` (see ``row_digest``).  Each value of ``group_col``
    has a tree of its leaves by ascending id; the trees' roots, ordered by group (null
    first, bytewise), have the tree whose root is the manifest.  ``proof_sha256`` is the
    digest of the siblings from leaf to root.  ``folded_root`` is what the proof leads to
    when the row is as ``changed`` (column -> expression) makes it, for rows where
    ``changed_where`` is true, else as it is; ``verified`` tells whether that is the root.

    Null ids come first and a null group is a group; rows of equal id and group are
    ordered by their leaf, so equal rows are leaves of their own side by side.  Null and
    empty values have different digests.  A row alone in the table is its own root.  An
    empty table gives no rows.  Columns not named play no part, whatever their names."""
    kind = rows.schema[id_col].dataType.simpleString()
    leaf = row_digest(F.col(c) for c in columns)
    other = F.lit(None).cast("string") if not changed else F.when(
        F.lit(True) if changed_where is None else changed_where, row_digest(changed.get(c, F.col(c)) for c in columns))
    leaves = materialise(rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("_tree"), F.col(id_col).alias("_id"),
        F.unhex(leaf).alias("_digest"), F.unhex(other).alias("_changed")), "leaves")
    leaves = _positions(leaves, ["_id", "_digest"], "leaves")
    rounds = _rounds(leaves, height, "nodes")
    subroots = _positions(rounds[-1].select(F.lit("").alias("_tree"), F.col("_tree").alias("_group"), "_digest"), ["_group"], "subroots")
    above = _rounds(subroots, height, "upper")

    one = F.lower(F.hex("_digest"))
    paths = above[-1].select("_tree", "_pos", F.expr(f"cast(array() as {PATH})").alias("_path"), F.lit("").alias("_subroot"), one.alias("_root"))
    for nodes in reversed(above[:-1]):
        paths = _descend(nodes, paths, height, "upper")
    # every group's subroot has its path: on to the groups' own trees
    paths = (subroots.select("_pos", F.col("_group"), one.alias("_own")).join(paths.select("_pos", "_path", "_root"), "_pos")
             .select(F.col("_group").alias("_tree"), F.lit(0).cast("long").alias("_pos"), "_path", F.col("_own").alias("_subroot"), "_root"))
    for nodes in reversed(rounds[1:-1]):
        paths = _descend(nodes, paths, height, "paths")
    folded = (_subtrees(leaves, height).cogroup(paths.withColumnRenamed("_pos", "_chunk").groupBy("_tree", "_chunk"))
              .applyInArrow(lambda rows, top: _fold(rows, top, height),
                            f"_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"))
    return folded.select(F.col("_id").alias(id_col), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(split({0}::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"""
_PART = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {0})"
ORACLE_SQL = f"""WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, {_LEAF.format(_PART.format('text'))} AS leaf,
    CASE WHEN {_CRC.format('doc_id')} % 5 = 0
      THEN {_LEAF.format(_PART.format(f"translate(text, '{UPPER}', '{LOWER}')"))}
      ELSE {_LEAF.format(_PART.format('text'))} END AS other
  FROM documents),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
  count(*) OVER (PARTITION BY source) AS n FROM d),
t AS (SELECT 0 AS l, source, p, n, leaf AS h FROM ranked
  UNION ALL SELECT l + 1, source, p // 16, any_value((n + 15) // 16), sha256(string_agg(h, '' ORDER BY p)) FROM t WHERE n > 1 GROUP BY l, source, p // 16),
s AS MATERIALIZED (SELECT source, h AS subroot, row_number() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS p, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS l, p, n, subroot AS h FROM s
  UNION ALL SELECT l + 1, p // 16, any_value((n + 15) // 16), sha256(string_agg(h, '' ORDER BY p)) FROM u WHERE n > 1 GROUP BY l, p // 16),
runs AS MATERIALIZED (SELECT l, source, p // 16 AS g, list(h ORDER BY p) AS hs FROM t WHERE n > 1 GROUP BY l, source, p // 16),
upper_runs AS MATERIALIZED (SELECT l, p // 16 AS g, list(h ORDER BY p) AS hs FROM u WHERE n > 1 GROUP BY l, p // 16),
f AS (SELECT doc_id, leaf, source, p AS row_p, 0 AS l, p, n, other AS h, '' AS proof FROM ranked
  UNION ALL SELECT f.doc_id, f.leaf, f.source, f.row_p, f.l + 1, f.p // 16, (f.n + 15) // 16,
    sha256(array_to_string(hs[:f.p % 16], '') || f.h || array_to_string(hs[f.p % 16 + 2:], '')),
    proof || array_to_string(hs[:f.p % 16], '') || array_to_string(hs[f.p % 16 + 2:], '')
  FROM f JOIN runs r ON r.l = f.l AND r.source IS NOT DISTINCT FROM f.source AND r.g = f.p // 16 WHERE f.n > 1),
e AS (SELECT f.doc_id, f.leaf, f.source, f.row_p, s.subroot, 0 AS l, s.p, s.n, f.h, f.proof FROM f JOIN s ON s.source IS NOT DISTINCT FROM f.source WHERE f.n = 1
  UNION ALL SELECT e.doc_id, e.leaf, e.source, e.row_p, e.subroot, e.l + 1, e.p // 16, (e.n + 15) // 16,
    sha256(array_to_string(hs[:e.p % 16], '') || e.h || array_to_string(hs[e.p % 16 + 2:], '')),
    proof || array_to_string(hs[:e.p % 16], '') || array_to_string(hs[e.p % 16 + 2:], '')
  FROM e JOIN upper_runs r ON r.l = e.l AND r.g = e.p // 16 WHERE e.n > 1)
SELECT e.doc_id, e.leaf, e.subroot, u.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = u.h AS verified
FROM e JOIN u ON u.n = 1 WHERE e.n = 1"""


@register("op13_manifest", ORACLE_SQL)
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof digest and folded root of every document; a fifth of the ids has its text's A-Z lower-cased."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.col("text")
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": lowered}, changed_where=hit)
