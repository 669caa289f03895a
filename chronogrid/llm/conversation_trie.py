"""Prefix trie of conversations, from sorted neighbours.

Every conversation is one row: a 16-byte key a turn (of its role and text), sorted
bytewise, so conversations that start alike are neighbours.  The longest common prefix
(LCP) of two neighbours is an edge between them.  Union-find takes the edges in
descending depth: a component holds the conversations that share its depth's turns, so
every merge creates (or widens) the branching node of that depth, and the turns between
two merges are nodes with one child.

A range sort deals the conversations to partitions, each read in blocks of bounded size.
What lies within a block is closed there; open are only the prefixes of its first and
last conversation.  They are what a block contracts to: two spines with what hangs on
each node.  Contracted forests of neighbours are merged across their boundaries by the
same union-find, ``MERGED`` partitions a task, until one is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import size_checked_broadcast
from ..session import materialise
from .joins import salted_join
from .registry import register

#: Bytes of a turn's key.
KEY = 16
#: Conversations and bytes of keys that a block holds.
BLOCK_ROWS, BLOCK_BYTES = 20_000, 8 << 20
#: Contracted forests that a task merges (as a power of two).
MERGED_BITS = 6
NO_ENDS = hashlib.sha256().hexdigest()
SPINE = "array<struct<depth:int,n_convs:long,conv_id:long,n_children:long,n_leaves:long,saved:long>>"
#: One table for what blocks and merges make: closed nodes, ends of open nodes, contracted forests.
MADE = (f"kind string, at long, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        f"saved long, ends string, node_id binary, parent_id binary, keys array<binary>, sizes array<array<int>>, spines array<{SPINE}>")
FIELDS = ["kind", "at", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends",
          "node_id", "parent_id", "keys", "sizes", "spines"]
_SPINE = pa.list_(pa.struct([("depth", pa.int32()), ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("n_children", pa.int64()),
                             ("n_leaves", pa.int64()), ("saved", pa.int64())]))
ARROW = pa.schema([("kind", pa.string()), ("at", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int32()), ("parent_conv_id", pa.int64()),
                   ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()),
                   ("node_id", pa.binary()), ("parent_id", pa.binary()), ("keys", pa.list_(pa.binary())),
                   ("sizes", pa.list_(pa.list_(pa.int32()))), ("spines", pa.list_(_SPINE))])


@dataclass
class Part:
    """What hangs on a node: conversations that end there, and closed children with their subtrees."""

    n_convs: int = 0
    conv_id: int | None = None
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0

    def add(self, other: Part) -> None:
        self.n_convs += other.n_convs
        if self.conv_id is None or (other.conv_id is not None and other.conv_id < self.conv_id):
            self.conv_id = other.conv_id
        self.n_children += other.n_children
        self.n_leaves += other.n_leaves
        self.saved += other.saved


@dataclass
class Path:
    """A conversation's turns (keys and sizes of their texts) and what hangs on its nodes, by depth."""

    keys: bytes
    sizes: list[int]
    hung: dict[int, Part] = field(default_factory=dict)
    _ids: list[bytes] | None = None

    @property
    def depth(self) -> int:
        return len(self.keys) // KEY

    def node_id(self, depth: int) -> bytes:
        """The name of the node of the first ``depth`` turns, the same on every conversation that starts with them."""
        if self._ids is None:
            state = hashlib.sha256()
            self._ids = [state.digest()[:KEY]]
            for k in range(0, len(self.keys), KEY):
                state.update(self.keys[k:k + KEY])
                self._ids.append(state.digest()[:KEY])
        return self._ids[depth]


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two conversations start with alike."""
    low, high = 0, min(len(a), len(b)) // KEY
    while low < high:
        middle = (low + high + 1) // 2
        if a[KEY * low:KEY * middle] == b[KEY * low:KEY * middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Sink:
    """Rows for the next stage, given out in batches."""

    def __init__(self):
        self.rows: list[dict] = []

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            for k in range(0, len(self.rows), 20_000):
                yield pa.RecordBatch.from_pylist(self.rows[k:k + 20_000], schema=ARROW)
            self.rows = []


def contract(paths: list[Path], sink: Sink, ids: list[int] | None = None, whole: bool = False) -> list[Path]:
    """Closes the nodes of sorted ``paths`` that reach beyond neither end; the rest is what the paths contract to.

    ``ids`` are given where each path is a conversation of its own, not a contracted
    forest's spine; equal neighbours then ascend by id.  With ``whole`` nothing lies
    beyond the ends and every node is closed."""
    m = len(paths)
    lcp = [0] + [common_turns(paths[k - 1].keys, paths[k].keys) for k in range(1, m)]
    root = list(range(m))
    first, last = list(range(m)), list(range(m))       # a component's interval
    at = [p.depth for p in paths]                      # depth of a component's top node
    hung = [dict(p.hung) for p in paths]               # what hangs on its nodes above the top
    top = [hung[k].pop(at[k], None) or Part() for k in range(m)]
    below: list[list[dict]] = [[] for _ in paths]      # closed children of the top node
    left: dict[int, Part] = {}
    right: dict[int, Part] = {}

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    def ends_of(k: int, depth: int) -> str | None:
        """Ids of the conversations that end at the node; they come first among those of the component."""
        if ids is None or paths[k].depth != depth:
            return None
        end = k + 1
        while end < m and lcp[end] == depth == paths[end].depth:
            end += 1
        return ",".join(map(str, ids[k:end]))

    def climb(c: int, to: int) -> None:
        """Finishes the nodes of component ``c`` that are deeper than ``to``."""
        path = paths[first[c]]
        while at[c] > to:
            d, part = at[c], top[c]
            ends = ends_of(first[c], d)
            if not whole and (first[c] == 0 or last[c] == m - 1):  # reaches beyond this block
                (left if first[c] == 0 else right)[d] = part
                for child in below[c]:
                    child["parent_id"] = path.node_id(d)
                if ends:
                    sink.rows.append({"kind": "ends", "conv_id": ids[first[c]], "ends": ends, "node_id": path.node_id(d)})
                above, children = Part(), []
            else:
                for child in below[c]:
                    child["parent_conv_id"] = part.conv_id
                if not part.n_children:
                    part.n_leaves = 1
                if d:
                    part.saved += (part.n_convs - 1) * path.sizes[d - 1]
                node = {"kind": "node", "conv_id": part.conv_id, "depth": d, "n_convs": part.n_convs, "n_children": part.n_children,
                        "n_leaves": part.n_leaves, "saved": part.saved}
                if ids is None:
                    node |= {"node_id": path.node_id(d), "parent_id": path.node_id(d - 1) if d else None}
                    children = []
                else:
                    node["ends"] = hashlib.sha256(ends.encode()).hexdigest() if ends else NO_ENDS
                    children = [node]
                sink.rows.append(node)
                above = Part(part.n_convs, part.conv_id, 1, part.n_leaves, part.saved)
            at[c], top[c], below[c] = d - 1, above, children
            if d - 1 in hung[c]:
                above.add(hung[c].pop(d - 1))

    for k in (np.argsort(-np.array(lcp[1:], np.int64), kind="stable") + 1).tolist():
        a, b = find(k - 1), find(k)
        climb(a, lcp[k])
        climb(b, lcp[k])
        if last[a] - first[a] < last[b] - first[b]:
            a, b = b, a
        root[b] = a
        first[a], last[a] = min(first[a], first[b]), max(last[a], last[b])
        top[a].add(top[b])
        if len(below[a]) < len(below[b]):
            below[a], below[b] = below[b], below[a]
        below[a].extend(below[b])
        for d, part in hung[b].items():
            hung[a].setdefault(d, Part()).add(part)
        top[b], below[b], hung[b] = Part(), [], {}
    climb(find(0), -1)
    if whole:
        return []
    ends = [Path(paths[0].keys, paths[0].sizes, left), Path(paths[-1].keys, paths[-1].sizes, right)]
    return ends[:1] if paths[0].keys == paths[-1].keys else ends


def _forest_row(paths: list[Path], at: int) -> dict:
    return {"kind": "forest", "at": at, "keys": [p.keys for p in paths], "sizes": [p.sizes for p in paths],
            "spines": [[{"depth": d, "n_convs": x.n_convs, "conv_id": x.conv_id, "n_children": x.n_children, "n_leaves": x.n_leaves,
                         "saved": x.saved} for d, x in p.hung.items()] for p in paths]}


def _build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one partition's sorted conversations; the partition contracts to one forest."""
    sink, forest, paths, ids, size = Sink(), [], [], [], 0

    def block() -> list[Path]:
        made = contract(paths, sink, ids)
        return contract(forest + made, sink) if forest else made

    for batch in batches:
        for conv, keys, sizes in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "keys", "sizes")), strict=True):
            paths.append(Path(keys, sizes, {len(keys) // KEY: Part(1, conv)}))
            ids.append(conv)
            size += len(keys)
            if len(paths) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                forest, paths, ids, size = block(), [], [], 0
                yield from sink.batches(1)
    if paths:
        forest = block()
    if forest:
        sink.rows.append(_forest_row(forest, TaskContext.get().partitionId()))
    yield from sink.batches(1)


def _merge(batches: Iterable[pa.RecordBatch], bits: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Contracted forests of neighbouring partitions, in order, merged group by group."""
    sink, forest, group = Sink(), [], None

    def ended() -> None:
        if forest and whole:
            contract(forest, sink, whole=True)
        elif forest:
            sink.rows.append(_forest_row(forest, group << bits))

    for batch in batches:
        for row in batch.to_pylist():
            paths = [Path(k, s, {x.pop("depth"): Part(**x) for x in hung})
                     for k, s, hung in zip(row["keys"], row["sizes"], row["spines"], strict=True)]
            if row["at"] >> bits != group:
                ended()
                forest, group = paths, row["at"] >> bits
            else:
                forest = contract(forest + paths, sink)
            yield from sink.batches(20_000)
    ended()
    yield from sink.batches(1)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of every node, whose pieces come in order."""
    node, state, done = None, None, []
    for batch in batches:
        for found, ends in zip(batch.column("node_id").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if found != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = found, hashlib.sha256(ends.encode())
            else:
                state.update(f",{ends}".encode())
    if node is not None:
        done.append((node, state.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], kind) for k, kind in enumerate((pa.binary(), pa.string()))],
                                     names=["node_id", "_ends"])


def sequences(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turns``: every conversation's turns in order, each a key (hex) and its text's code points.

    Turns ascend, null first; turns of equal number are ordered by their key.  A null role
    or text is empty.  Rows without a conversation id belong to none and are left out."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * KEY)
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.struct(F.col(turn_col).cast("long").alias("turn"), key.alias("key"), F.length(text).alias("size")).alias("t"))
    return (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns")))


def with_shared_heads(convs: DataFrame, every: int = 100, longest: int = 6) -> DataFrame:
    """Conversation c starts with the first h turns of conversation c - c % ``every`` in place of its own first h;
    h is the CRC-32 of its decimal id modulo ``longest``.  A conversation that doesn't exist has no turns."""
    heads = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, longest - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("int")
    return (convs.join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left")
            .select("conv_id", F.concat(F.coalesce(F.slice("_head", F.lit(1), h), F.slice("turns", 1, 0)),
                                        F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns")))


def prefix_trie(convs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``convs`` (``conv_id, turns`` as ``sequences`` gives them).

    A node is a distinct sequence of first turns; its members are the conversations that
    start with it.  Columns: ``conv_id`` (smallest member) and ``depth`` (its text is that
    conversation's ``depth``-th turn), ``parent_conv_id`` (null at the root), ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` of its subtree (code points that a
    cache of shared prefixes saves), ``ends_sha256`` (SHA-256 of the ids, ascending and
    comma-joined, of members without further turns).  Conversations without turns end at
    the root; no conversations give no nodes.  A conversation is one row of 20 bytes a turn;
    groups of equal conversations or of equal first turns spread over partitions."""
    spark = convs.sparkSession
    rows = materialise(convs.select("conv_id", F.unhex(F.array_join("turns.key", "")).alias("keys"), F.col("turns.size").alias("sizes")), "convs")
    rows = rows.repartitionByRange("keys", "conv_id").sortWithinPartitions("keys", "conv_id")
    made = [materialise(rows.mapInArrow(_build, MADE), "trie")]
    end = made[0].where("kind = 'forest'").agg(F.max("at")).first()[0]
    bits = 0
    while end is not None and (bits == 0 or end >> bits):
        bits += MERGED_BITS
        forests = made[-1].where("kind = 'forest'").select("at", "keys", "sizes", "spines", F.expr(f"shiftright(at, {bits})").alias("_group"))
        forests = forests.repartition("_group").sortWithinPartitions("_group", "at").select("at", "keys", "sizes", "spines")
        made.append(materialise(forests.mapInArrow(
            lambda batches, bits=bits, whole=not end >> bits: _merge(batches, bits, whole), MADE), "trie"))
    merged = made[0]  # a partition of several blocks merges their forests already
    for more in made[1:]:
        merged = merged.unionByName(more)

    # nodes that were open: their ends come in pieces, and closed children know them by name only
    pieces = made[0].where("kind = 'ends'").select("node_id", "conv_id", "ends")
    ends = pieces.repartition("node_id").sortWithinPartitions("node_id", "conv_id").mapInArrow(_digests, "node_id binary, _ends string")
    opened = materialise(merged.where("kind = 'node' AND node_id IS NOT NULL").drop("ends").join(ends, "node_id", "left")
                         .withColumn("ends", F.coalesce("_ends", F.lit(NO_ENDS))).drop("_ends"), "opened")
    names = opened.select(F.col("node_id").alias("parent_id"), F.col("conv_id").alias("_parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    closed = made[0].where("kind = 'node' AND node_id IS NULL")
    orphans = closed.where("parent_id IS NOT NULL").unionByName(opened.where("depth > 0").select(closed.columns))
    side = size_checked_broadcast(names, 64)
    found = (orphans.join(side, "parent_id") if side is not names else
             salted_join(orphans, names, ["parent_id"], F.xxhash64("conv_id", "depth")))
    nodes = (closed.where("parent_id IS NULL").select(columns)
             .unionByName(found.withColumn("parent_conv_id", F.col("_parent")).select(columns))
             .unionByName(opened.where("depth = 0").select(columns)))
    return nodes.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(split(conv_id::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"""
ORACLE_SQL = f"""WITH t AS (
  SELECT conv_id, turn, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(struct_pack(k := k, size := size) ORDER BY turn NULLS FIRST, k) AS turns FROM t GROUP BY conv_id),
h AS (SELECT conv_id, turns, {_CRC} % 6 AS h FROM c),
r AS MATERIALIZED (SELECT h.conv_id, list_concat(coalesce(b.turns[:h], []), h.turns[h + 1:]) AS turns
  FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS MATERIALIZED (SELECT conv_id, d, len(turns) AS n, CASE WHEN d > 0 THEN turns[d].size ELSE 0 END AS size,
    sha256(array_to_string(list_transform(turns[:d], lambda x: x.k), '')) AS node,
    CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(turns[:d - 1], lambda x: x.k), '')) END AS parent
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM r)),
nodes AS MATERIALIZED (SELECT node, d, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, any_value(size) AS size,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends FROM p GROUP BY node, d),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
sums AS (SELECT a.node, sum((x.n_convs - 1) * x.size) AS saved, count(*) FILTER (k.node IS NULL) AS n_leaves
  FROM nodes x LEFT JOIN kids k ON k.node = x.node JOIN p a ON a.conv_id = x.conv_id AND a.d <= x.d GROUP BY a.node)
SELECT n.conv_id, n.d::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
  s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN nodes q ON q.node = n.parent"""


@register("op11_conversation_trie", ORACLE_SQL)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, each with the shared head of its hundred."""
    return prefix_trie(with_shared_heads(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
