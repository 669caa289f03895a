"""Interpolated modified Kneser-Ney n-gram models, counted and asked by sharded joins.

The units are the UTF-16 code units of a text, each for itself: no class, alphabet or
table bounds them, and an n-gram of ``ORDER`` units is one 64-bit number.  Counts,
continuation counts, discounts and context sums are tables in Spark, sharded by model
and n-gram, that grow with the text.

Documents are scored by joins with these tables.  Their rows are packed into blocks; a
block asks each of its n-grams once, distinct n-grams of all blocks are joined with the
counts order by order, and the answers go back to the blocks that asked.  So no model is
broadcast or collected, and an n-gram is a row once a block, not once a document.  The
packed rows are written in buckets of their blocks and never shuffled: answers come to them.
Bits of an answer are single precision, as sums are double.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, remove_path, scratch_path, shuffles_dropped
from .arrow import texts_as_bytes
from .worker import kept

ORDER = 4
#: Bits of a unit: an n-gram of ``ORDER`` of them fills a long.
BITS = 16
UNITS = 1 << BITS
#: Stands before a text.  A high surrogate is never followed by another or by a whole
#: character, so no n-gram within a text equals one that holds it.
BEFORE = 0xD800
#: Characters of a text, and n-grams, that are held at a time.
CHUNK = 1 << 20
#: Bytes of rows in a block, a larger row has one of its own.  More lower what is asked twice, and take memory.
BLOCK = 16 << 20
#: Level of the rows' compression.
LEVEL = 6


class Model(NamedTuple):
    """``grams`` (``model, n, gram, cut``: count less discount), ``contexts`` (``model, n,
    context, total, mass``: sums of counts and of discounts) and the number of each model by its name."""
    grams: DataFrame
    contexts: DataFrame
    names: dict[str, int]


def unit_grams(text: str) -> Iterator[np.ndarray]:
    """The n-grams of order ``ORDER`` of a text as numbers, one for each code unit."""
    before = np.full(ORDER - 1, BEFORE, np.uint64)
    for at in range(0, len(text), CHUNK):
        s = np.concatenate([before, np.frombuffer(text[at:at + CHUNK].encode("utf-16-le"), "<u2").astype(np.uint64)])
        n = len(s) - ORDER + 1
        g = s[:n].copy()
        for k in range(1, ORDER):
            g <<= np.uint64(BITS)
            g |= s[k:k + n]
        before = s[n:]
        yield g.view(np.int64)


def count_units(texts: DataFrame) -> DataFrame:
    """``lang, gram, c`` over all rows of ``lang, text``; each task adds up ``CHUNK`` n-grams at a time first."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("c", pa.int64())])
    owner = uuid.uuid4().hex

    def out(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            found = pc.value_counts(pa.array(np.concatenate(parts)))
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(found), np.int64))), *found.flatten()], schema=schema)
        held.clear()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(owner)
        held: dict[str, list[np.ndarray]] = {}
        n = 0
        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), texts_as_bytes(batch, "text")):
                for g in unit_grams((raw or b"").decode(errors="replace")):
                    held.setdefault(lang, []).append(g)
                    n += len(g)
                    if n >= CHUNK:
                        yield from out(held)
                        n = 0
        yield from out(held)

    return texts.mapInArrow(run, "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def _ends(gram: str, n: int, units: int) -> Column:
    """The last n units of an n-gram."""
    return F.pmod(F.col(gram), F.lit(units ** n).cast("long")) if n < ORDER else F.col(gram)


def _context(units: int) -> Column:
    """An n-gram less its last unit, as whole numbers: the n-gram fills a long, with its sign."""
    return F.expr(f"(gram - pmod(gram, {units}L)) div {units}L")


def estimate(counts: DataFrame, units: int = UNITS) -> tuple[DataFrame, DataFrame]:
    """``grams`` and ``contexts`` of ``lang, gram, c``, for n from 1 to ``ORDER``.

    The probability of an n-gram is ``(cut + mass * that of the n-gram less its first unit) /
    total``.  Orders below the highest count the distinct units seen before an n-gram.
    Discounts for counts of one, two and more follow from the counts of counts of
    each language and order."""
    # each order is written: plans stay small, as the driver keeps and replans them
    level = materialise(counts, "grams")
    seen = level.withColumn("n", F.lit(ORDER))
    for n in range(ORDER - 1, 0, -1):
        level = materialise(level.groupBy("lang", _ends("gram", n, units).alias("gram")).agg(F.count("*").alias("c")), "grams")
        seen = seen.unionByName(level.withColumn("n", F.lit(n)))
    of = [F.sum(F.when(F.col("c") == k, 1).otherwise(0)).alias(f"n{k}") for k in range(1, 5)]
    y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.5))

    def discount(k: int) -> Column:
        value = F.when(F.col(f"n{k}") > 0, k - (k + 1) * F.col("y") * F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(k * F.lit(0.5))
        return F.least(F.greatest(value, F.lit(0.05)), F.lit(k - 0.05)).alias(f"d{k}")

    discounts = materialise(seen.groupBy("lang", "n").agg(*of).withColumn("y", y).select("lang", "n", *[discount(k) for k in (1, 2, 3)]), "discounts")
    taken = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    # one row a language and order
    seen = seen.join(F.broadcast(discounts), ["lang", "n"]).select("lang", "n", "gram", "c", taken.alias("taken"), _context(units).alias("context"))
    contexts = seen.groupBy("lang", "n", "context").agg(F.sum("c").alias("total"), F.sum(F.col("taken").cast("decimal(30,15)")).cast("double").alias("mass"))
    return seen.select("lang", "n", "gram", "context", (F.col("c") - F.col("taken")).alias("cut")), materialise(contexts, "contexts")


def numbered(grams: DataFrame, contexts: DataFrame) -> Model:
    """The model of both tables of ``estimate``, its names numbered; they are as many as languages."""
    names = sorted(r["lang"] for r in contexts.where("n = 1").select("lang").distinct().collect())
    number = (F.array_position(F.array(*[F.lit(x) for x in names]).cast("array<string>"), F.col("lang")) - 1).cast("int").alias("model")
    return Model(materialise(grams.select(number, "n", "gram", "cut"), "model"), contexts.select(number, "n", "context", "total", "mass"), {x: k for k, x in enumerate(names)})


def _lazy(df: DataFrame, name: str) -> DataFrame:
    return df


def probabilities(asked: DataFrame, model: Model, step: Callable[[DataFrame, str], DataFrame] = _lazy) -> DataFrame:
    """``model, gram, p`` of the distinct ``model, gram`` asked, of order ``ORDER``: at each order joined
    with its counts and contexts, and with the probability of the n-gram less its first unit.

    Each order goes through ``step``, as ``materialise``."""
    lower = None
    for n in range(1, ORDER + 1):
        level = asked.select("model", _ends("gram", n, UNITS).alias("gram"))
        level = (level if n == ORDER else level.distinct()).select(
            "model", "gram", _context(UNITS).alias("context"), _ends("gram", n - 1, UNITS).alias("less"))
        if lower is None:
            level = level.withColumn("below", F.lit(1.0 / UNITS))
        else:
            level = level.join(lower.select("model", F.col("gram").alias("less"), F.col("p").alias("below")), ["model", "less"])
        level = (level.join(model.contexts.where(F.col("n") == n).drop("n"), ["model", "context"], "left")
                 .join(model.grams.where(F.col("n") == n).drop("n"), ["model", "gram"], "left"))
        p = F.coalesce((F.coalesce("cut", F.lit(0.0)) + F.col("mass") * F.col("below")) / F.col("total"), F.col("below"))
        lower = step(level.select("model", "gram", p.alias("p")), "probabilities")
    return lower


def _bucketed(rows: DataFrame, key: str, path: str) -> DataFrame:
    """``rows`` written to ``path`` in buckets of ``key`` and read back: what meets them by ``key`` comes to them.

    Only a table can name its buckets; it leaves the catalog at once, its files stay."""
    spark, name = rows.sparkSession, f"blocks_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_dropped(spark):
        rows.write.bucketBy(n, key).option("path", path).saveAsTable(name, format="parquet")
    written = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return written


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    return np.sort(pc.unique(pa.array(np.concatenate(parts))).to_numpy())


def _same(n: int, x: int | None, kind: pa.DataType) -> pa.Array:
    return pa.nulls(n, kind) if x is None else pa.array(np.full(n, x), kind)


def _packed_answers(answers: DataFrame) -> DataFrame:
    """``block, model, answers`` of ``block, model, gram, p``: many answers to a block in one row, n-grams as differences."""
    owner = uuid.uuid4().hex

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, model, gram, p = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in ("block", "model", "gram", "p"))
        order = np.lexsort((gram, model, block))
        block, model, gram, bits = block[order], model[order], gram[order], -np.log2(p[order])
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(block) != 0) | (np.diff(model) != 0)]))
        codec = pa.Codec("zstd")
        rows = [codec.compress(np.diff(gram[a:b], prepend=0).tobytes() + bits[a:b].astype(np.float32).tobytes(), asbytes=True)
                for a, b in zip(starts, [*starts[1:], len(gram)])]
        sizes = np.diff([*starts, len(gram)])
        yield pa.RecordBatch.from_arrays([pa.array(block[starts]), pa.array(model[starts], pa.int32()), pa.array(sizes, pa.int32()), pa.array(rows, pa.binary())],
                                         names=["block", "model", "n", "packed"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(owner)
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= CHUNK:
                yield from packed(held)
                held, n = [], 0
        if held:
            yield from packed(held)

    return answers.select("block", "model", "gram", "p").mapInArrow(run, "block long, model int, n int, packed binary")


def with_perplexity(docs: DataFrame, model: Model, text_col: str, model_cols: dict[str, str],
                    without: tuple[str, ...] = (), other: str | None = None, keep_as: str | None = None,
                    step: Callable[[DataFrame, str], DataFrame] = _lazy) -> DataFrame:
    """``docs`` less ``without``, plus ``n_symbols`` (characters) and the perplexities (per character; null without text or model).

    ``model_cols``: for each perplexity the column that names its model; ``other`` stands for a name that no model has.
    ``keep_as``: the result is written under that name, and the packed rows are deleted.
    ``step``: what every join of an order and the answers go through; ``materialise`` keeps the driver's plans
    small and drops the shuffle files of the joins before the next."""
    numbers, owner, asker = model.names, uuid.uuid4().hex, uuid.uuid4().hex
    made = [("n_symbols", T.LongType()), *[(name, T.DoubleType()) for name in model_cols]]
    keep = [f for f in docs.schema.fields if f.name not in without and f.name.lower() not in {n.lower() for n, _ in made}]
    schema = T.StructType(keep + [T.StructField(n, t) for n, t in made])

    def texts(batch: pa.RecordBatch) -> Iterator[tuple[str, list[int | None]]]:
        """Each text and the numbers of its models."""
        names = [batch.column(c).to_pylist() for c in model_cols.values()]
        for raw, *own in zip(texts_as_bytes(batch, text_col), *names):
            yield (raw or b"").decode(errors="replace"), [numbers.get(x if x in numbers else other) for x in own]

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a block, compressed, and then the n-grams that it asks; ``nth`` counts the rows of a block."""
        kept(asker)
        held: dict[int, list[np.ndarray]] = {}
        sizes: dict[int, int] = {}
        size = nth = 0
        names = ["nth", "model", "gram", "packed"]

        def asked() -> Iterator[pa.RecordBatch]:
            nonlocal size, nth
            for number in sorted(held):
                g = _distinct(held[number])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(nth, nth + len(g))), _same(len(g), number, pa.int32()), pa.array(g), pa.nulls(len(g), pa.binary())], names=names)
                nth += len(g)
            held.clear()
            sizes.clear()
            size = nth = 0

        for batch in batches:
            if not batch.num_rows:
                continue
            for text, own in texts(batch):
                for g in unit_grams(text) if own != [None] * len(own) else ():
                    for number in own:
                        if number is not None:
                            held.setdefault(number, []).append(g)
                            sizes[number] = sizes.get(number, 0) + len(g)
                            if sizes[number] >= CHUNK:
                                held[number], sizes[number] = [_distinct(held[number])], 0
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as writer:
                writer.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([nth], pa.int64()), _same(1, None, pa.int32()), _same(1, None, pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=names)
            nth, size = nth + 1, size + batch.nbytes
            if size >= BLOCK:
                yield from asked()
        yield from asked()

    def scored(part: pa.RecordBatch, answers: dict[int, tuple[pa.Array, np.ndarray]]) -> pa.RecordBatch:
        n: list[int] = []
        bits: list[list[float | None]] = [[] for _ in model_cols]
        waiting: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        sizes: dict[tuple[int, int], int] = {}

        def add(key: tuple[int, int]) -> None:
            grams, value = answers[key[1]]
            found = pc.index_in(pa.array(np.concatenate([g for _, g in waiting[key]])), value_set=grams)
            if found.null_count:
                raise RuntimeError("an n-gram was not answered")
            each, at = value[found.to_numpy()], 0
            for row, g in waiting[key]:
                bits[key[0]][row] += float(each[at:at + len(g)].sum(dtype=np.float64))
                at += len(g)
            del waiting[key], sizes[key]

        for row, (text, own) in enumerate(texts(part)):
            n.append(len(text))
            for k, number in enumerate(own):
                bits[k].append(None if number is None or not text else 0.0)
            for g in unit_grams(text) if own != [None] * len(own) else ():
                for key in enumerate(own):
                    if key[1] is not None:
                        waiting.setdefault(key, []).append((row, g))
                        sizes[key] = sizes.get(key, 0) + len(g)
                        if sizes[key] >= CHUNK:
                            add(key)
        for key in list(waiting):
            add(key)
        perplexities = [pa.array([None if b is None else 2.0 ** (b / k) for b, k in zip(x, n)], pa.float64()) for x in bits]
        return pa.RecordBatch.from_arrays([part.column(f.name) for f in keep] + [pa.array(n, pa.int64()), *perplexities],
                                          names=[f.name for f in keep] + [name for name, _ in made])

    def score(found: pa.Table, rows: pa.Table) -> pa.Table:
        """The rows of a block by its answers."""
        kept(owner)
        codec, parts = pa.Codec("zstd"), {}
        for number, n, packed in zip(*(found.column(k).to_pylist() for k in ("model", "n")), found.column("packed")):
            raw = codec.decompress(packed.as_buffer(), 12 * n)
            parts.setdefault(number, []).append((np.cumsum(np.frombuffer(raw, np.int64, n)), np.frombuffer(raw, np.float32, n, 8 * n)))
        answers = {x: (pa.array(np.concatenate([g for g, _ in of])), np.concatenate([b for _, b in of])) for x, of in parts.items()}
        return pa.Table.from_batches([scored(part, answers) for packed in rows.column("packed") for part in pa.ipc.open_stream(packed.as_buffer())])

    # numbered once, when written: every later pass sees the same blocks, each named by its first row
    spark = docs.sparkSession
    path = scratch_path(spark, "blocks")
    blocks = _bucketed(docs.mapInArrow(ask, "nth long, model int, gram long, packed binary").select(
        (F.monotonically_increasing_id() - F.col("nth")).alias("block"), "model", "gram", "packed"), "block", path)
    asked = blocks.where("model IS NOT NULL").select("block", "model", "gram")
    distinct = materialise(asked.select("model", "gram").distinct(), "asked")  # every order reads it
    answers = step(_packed_answers(asked.join(probabilities(distinct, model, step), ["model", "gram"])), "answers")
    # the rows lie by block where they were written: only answers are shuffled
    rows = blocks.where("model IS NULL").select("block", "packed")
    scored_rows = answers.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(score, schema)
    if keep_as is None:
        return scored_rows
    scored_rows = materialise(scored_rows, keep_as)
    remove_path(spark, path)
    return scored_rows


#: ``lang, text`` to ``lang, gram, c``.
Counter = Callable[[DataFrame], DataFrame]
