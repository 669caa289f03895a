"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton is built over the words of all items.  Training words stream through
it; the length of the longest match that ends at each word tells which words lie in
a window that also stands in an item.  Items are sharded so that one automaton has
a bounded number of words: only that is collected and broadcast at a time.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise
from .arrow import texts_as_bytes, with_arrow_columns
from .registry import register
from .suffix_automaton import SuffixAutomaton

#: Words are ASCII letters and digits and all letters beyond ASCII; A-Z lower-cased.
WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
                   for c in range(256))
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Most words of the items of one automaton (about 100 MB in a worker).
SHARD_WORDS = 200_000


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(WORD_BYTES).split()


class ItemAutomaton(SuffixAutomaton):
    """Generalised suffix automaton over the words of items, with their windows."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.names = window, [n for n, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        super().__init__()
        for _, words in items:
            self.add(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words)
        # items whose window ends in a state; whole items shorter than a window
        self.windows: dict[int, set[int]] = {}
        self.short: dict[int, dict[int, set[int]]] = {}
        self.least = window
        for k, (_, words) in enumerate(items):
            path = self.states(self.vocabulary[w] for w in words)
            if len(path) >= window:
                for s in path[window - 1:]:
                    self.windows.setdefault(self._lift(s), set()).add(k)
            elif path:
                self.short.setdefault(path[-1], {}).setdefault(len(path), set()).add(k)
                self.least = min(self.least, len(path))
        # nearest state above with a short item
        self.above = [-1] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            p = self.link[s]
            self.above[s] = p if p in self.short else self.above[p] if p >= 0 else -1

    def _lift(self, s: int) -> int:
        """The state of the last ``window`` words of a longer match."""
        while self.length[self.link[s]] >= self.window:
            s = self.link[s]
        return s

    def hits(self, words: list[bytes]) -> tuple[bytearray, set[int]]:
        """A mark for each word inside an occurrence of a window, and the items met."""
        marks, met = bytearray(len(words)), set()
        if len(words) < self.least:
            return marks, met
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        gaps = np.r_[-1, np.flatnonzero(ids < 0), len(ids)]
        long_runs = np.flatnonzero(np.diff(gaps) > self.least)
        step, link, length, window = self.step, self.link, self.length, self.window
        for g in long_runs:
            begin, s, n = int(gaps[g]) + 1, 0, 0
            for at, c in enumerate(ids[begin:int(gaps[g + 1])].tolist(), begin):
                while s and c not in step[s]:
                    s = link[s]
                    n = length[s]
                if c in step[s]:
                    s, n = step[s][c], n + 1
                if n >= window:
                    marks[at - window + 1:at + 1] = b"\1" * window
                    met |= self.windows.get(self._lift(s), set())
                if self.short:
                    u = s if s in self.short else self.above[s]
                    while u >= 0:
                        for k, items in self.short[u].items():
                            if u != s or n >= k:
                                marks[at - k + 1:at + 1] = b"\1" * k
                                met |= items
                        u = self.above[u]
        return marks, met


def cut_marked(raw: bytes, marks: bytearray, longest: int) -> bytes:
    """The text without runs of more than ``longest`` marked words, blanks between them included."""
    kept, at, run = [], 0, None
    spans = [m.span() for m in WORD.finditer(raw)]
    for k in range(len(spans) + 1):
        if k < len(spans) and marks[k]:
            run = k if run is None else run
        elif run is not None:
            if k - run > longest:
                kept.append(raw[at:spans[run][0]])
                at = spans[k - 1][1]
            run = None
    return b"".join(kept) + raw[at:]


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 13, share: float = 0.05, cut_longer_than: int | None = None,
                  without: tuple[str, ...] = (), shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` less ``without``, plus ``n_words, n_hit, items_met, contaminated``.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an
    item, or of a whole shorter item.  ``items_met`` lists the items with such
    occurrences as strings, sorted.  A document is contaminated when some word is
    hit and hits are at least ``share`` of its words.  With ``cut_longer_than``
    a column ``clean_text`` has the runs of more hit words than that cut out.
    A null text has no words and stays null; null or wordless items match nothing;
    an item with a null id counts under the empty name.  Repeated rows each come
    back, repeated items count once by id.  An empty benchmark hits nothing."""
    spark = docs.sparkSession
    measure = F.size(F.split(F.coalesce(F.col(item_text), F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("item"),
                         measure.cast("long").alias("n")).where("item IS NOT NULL")
    total = named.agg(F.sum("n")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_words))
    fields = [("_marks", T.BinaryType()), ("_met", T.ArrayType(T.StringType()))]
    state = docs
    for k in range(shards):
        part = named if shards == 1 else named.where(F.pmod(F.xxhash64("item"), F.lit(shards)) == k)
        rows = part.select("name", F.col("item").cast("binary")).collect()  # about shard_words words
        shared = spark.sparkContext.broadcast(ItemAutomaton([(r[0], words_of(r[1])) for r in rows], window))

        def start(shared=shared, first=k == 0):
            automaton = shared.value

            def compute(batch: pa.RecordBatch) -> list[pa.Array]:
                marks, met = [], []
                for i, raw in enumerate(texts_as_bytes(batch, text_col)):
                    m, items_met = automaton.hits(words_of(raw))
                    names = {automaton.names[x] for x in items_met}
                    if not first:
                        before = batch.column("_marks")[i].as_py()
                        m = bytearray(a | b for a, b in zip(m, before)) if names else bytearray(before)
                        names |= set(batch.column("_met")[i].as_py())
                    marks.append(bytes(m))
                    met.append(sorted(names))
                return [pa.array(marks, pa.binary()), pa.array(met, pa.list_(pa.string()))]
            return compute

        if shards == 1:
            break
        again = with_arrow_columns(state, start, fields, ("_marks", "_met"))
        state = materialise(again, "hits")

    last = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("items_met", T.ArrayType(T.StringType())),
            ("contaminated", T.BooleanType())] + [("clean_text", T.StringType())] * (cut_longer_than is not None)

    least = Fraction(str(share))

    def finish():
        first = start() if shards == 1 else None

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            marks, met = [c.to_pylist() for c in (first(batch) if first else (batch.column("_marks"), batch.column("_met")))]
            n_words, n_hit = [len(m) for m in marks], [m.count(1) for m in marks]
            out = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(met, pa.list_(pa.string())),
                   pa.array([h > 0 and h * least.denominator >= least.numerator * n for h, n in zip(n_hit, n_words)], pa.bool_())]
            if cut_longer_than is not None:
                out.append(pa.array([raw if raw is None or not h else cut_marked(raw, m, cut_longer_than)
                                     for raw, m, h in zip(texts_as_bytes(batch, text_col), marks, n_hit)], pa.binary()).cast(pa.string()))
            return out
        return compute

    return with_arrow_columns(state, finish, last, (*without, "_marks", "_met"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')"""
ORACLE_SQL = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(13, len(w)) AS k, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS gram
      FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
o AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS gram
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT k FROM g) WHERE len(w) >= k)),
m AS (SELECT DISTINCT o.doc_id, o.k, o.p, g.item FROM o JOIN g ON o.k = g.k AND o.gram = g.gram),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id"""


@register("op8_decontamination", ORACLE_SQL)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and items met of every document against the benchmark's 13-word windows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, items, without=("text",)).select(
        "doc_id", "n_words", "n_hit", F.size("items_met").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items_met"), 256).alias("items_sha256"),
        F.expr("n_hit > 0 AND 20 * n_hit >= n_words").alias("contaminated"))
