"""The model of ``kneser_ney.py`` over a bounded alphabet, where every probability fits one array.

Its counts, discounts and context sums are those of ``estimate``; so the tables can be
held against the definition for all n-grams, not only for those asked.  No query
scores documents by it.  The symbols are the letters a-z and classes of the other
characters, ``SYMBOLS`` in all.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import texts_as_bytes
from .kneser_ney import CHUNK, ORDER
from .worker import kept

SYMBOLS = 40
#: Most languages whose dense counts (10 MB) a worker holds at once.
HELD = 10


def _symbol_table() -> np.ndarray:
    """The symbol of each character up to U+FFFF; 0 stands before the text.

    1-26 letters a-z, 27 upper case, 28 digits, 29 blanks, 30 line ends, 31 full
    stop, 32 comma, 33-35 other ASCII in three classes, 36-39 all else in four."""
    c = np.arange(1 << 16)
    table = 36 + c % 4
    table[:128] = 33 + c[:128] % 3
    table[97:123] = c[97:123] - 96
    table[65:91], table[48:58] = 27, 28
    table[[9, 11, 12, 13, 32]], table[10], table[46], table[44] = 29, 30, 31, 32
    return table.astype(np.int64)


TABLE = _symbol_table()


def grams(raw: bytes) -> Iterator[np.ndarray]:
    """The n-grams of order ``ORDER`` of a UTF-8 text as numbers, one for each character."""
    before = np.zeros(ORDER - 1, np.int64)
    text = raw.decode()
    for at in range(0, len(text), CHUNK):
        c = np.frombuffer(text[at:at + CHUNK].encode("utf-32-le"), "<u4")
        s = np.concatenate([before, TABLE[np.where(c < 1 << 16, c, (c & 3) + 0x3000)]])
        n = len(c)
        g = s[:n].copy()
        for k in range(1, ORDER):
            g *= SYMBOLS
            g += s[k:k + n]
        before = s[n:]
        yield g


def count_symbols(texts: DataFrame) -> DataFrame:
    """``lang, gram, c`` over all rows of ``lang, text``; each task adds up its own first."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("c", pa.int64())])
    owner = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(owner)
        sums: dict[str, np.ndarray] = {}  # a task's counts fit 32 bits: they are of one split of the input

        def out(lang: str) -> pa.RecordBatch:
            found = np.flatnonzero(sums[lang])
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(sums[lang][found].astype(np.int64))], schema=schema)

        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), texts_as_bytes(batch, "text")):
                if lang not in sums:
                    if len(sums) == HELD:  # bounded memory for any number of languages
                        yield from (out(x) for x in sums)
                        sums.clear()
                    sums[lang] = np.zeros(SYMBOLS ** ORDER, np.uint32)
                for g in grams(raw or b""):
                    np.add.at(sums[lang], g, 1)
        yield from (out(x) for x in sums)

    return texts.mapInArrow(run, "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def dense_models(grams: DataFrame, contexts: DataFrame) -> dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """For each model and order n-grams, own and rest: a probability is own plus rest times the shorter one's.

    What reaches the driver is bounded by the symbols and the order, not by the text."""
    table = grams.join(contexts, ["lang", "n", "context"]).select(
        "lang", "n", "gram", (F.col("cut") / F.col("total")).alias("own"), (F.col("mass") / F.col("total")).alias("rest")).toArrow()
    names = table.column("lang").combine_chunks().dictionary_encode()
    lang = names.indices.to_numpy(zero_copy_only=False)
    n, gram, own, rest = (table.column(k).to_numpy() for k in ("n", "gram", "own", "rest"))
    models = {}
    for i, name in enumerate(names.dictionary.to_pylist()):
        rows = lang == i
        models[name] = [tuple(x[rows & (n == k)] for x in (gram, own, rest)) for k in range(1, ORDER + 1)]
    return models


def dense_bits(model: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """-log2 of the probability of every n-gram of the highest order."""
    p = np.full(1, 1.0 / SYMBOLS)
    for n, (gram, own, rest) in enumerate(model, 1):
        weight = np.ones(SYMBOLS ** (n - 1))
        weight[gram // SYMBOLS] = rest
        p = np.tile(p, SYMBOLS ** n // len(p))
        p *= np.repeat(weight, SYMBOLS)
        p[gram] += own
    return -np.log2(p).astype(np.float32)
