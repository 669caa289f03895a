"""Language identification by compression.

Each language has a raw-content zstandard dictionary of the words and word pairs that
are most frequent in a bounded sample of its labelled texts, all of them read whole; the
commonest come last, where the encoder reaches them best.  A text is encoded with every dictionary; the language whose
encoding is smallest is predicted, and the prediction is rejected when the margin
to the next one is narrow.  Texts are reduced to lower-case letters and single
blanks first, so layout, digits and punctuation say nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..operators.joins import size_checked_broadcast
from .arrow import texts_as_bytes, with_arrow_columns
from .registry import register

#: The labelled sample: texts of each language (those of the smallest hashes, so
#: spread over all sources) and bytes of its dictionary.
SAMPLE_TEXTS = 300
DICTIONARY_BYTES = 128 * 1024
#: Texts are encoded whole, in blocks small enough that the dictionary stays in reach.
BLOCK_BYTES = 4096
LEVEL = 12
#: Smallest relative margin between the best and the second encoding.
MIN_MARGIN = 0.01
#: Most bytes of all dictionaries together (they are broadcast): very many labels get smaller ones.
MAX_DICTIONARIES = 256 * 1024 * 1024

NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters_only(raw: bytes | None) -> bytes:
    """Lower-case words between single blanks; empty if the text has no letter."""
    text = NOT_LETTERS.sub(" ", (raw or b"").decode().lower()).strip()
    return f" {text} ".encode() if any(map(str.isalpha, text)) else b""


def _phrases(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, phrase, n``: words and pairs of neighbouring words of each whole text."""
    for batch in batches:
        counts: Counter[tuple[str, bytes]] = Counter()
        for lang, raw in zip(batch.column("lang").to_pylist(), texts_as_bytes(batch, "text")):
            words = letters_only(raw).split()
            counts.update((lang, w) for w in words)
            counts.update((lang, a + b" " + b) for a, b in zip(words, words[1:]))
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.binary()),
                                          pa.array(counts.values(), pa.int64())], names=["lang", "phrase", "n"])


def learn_dictionaries(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                       sample_texts: int = SAMPLE_TEXTS, size: int = DICTIONARY_BYTES) -> list[tuple[str, bytes]]:
    """A dictionary for each label of ``docs``, the commonest label first.

    Of each label ``sample_texts`` distinct texts, those of the smallest hashes, are read
    whole; their words and pairs of words are counted in Spark, and the most frequent ones,
    ``size`` bytes a label, reach the driver.  Only label and hash pass through the ranking
    of texts.  So many labels that all dictionaries would exceed ``MAX_DICTIONARIES`` share
    it evenly.  Rows without text, label or letters teach nothing."""
    known = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.withColumn("h", F.xxhash64("text"))
    by_hash = known.select("lang", "h").distinct()
    sizes = by_hash.groupBy("lang").agg(F.count("*").alias("n"))
    labels = sizes.count()
    if not labels:
        return []
    size = min(size, MAX_DICTIONARIES // labels)
    # hashes are uniform: the lowest 2 x sample_texts of n lie below this share, so few rows of a label are ranked
    share = F.least(F.lit(1.0), F.lit(2.0 * sample_texts) / F.col("n"))
    bound = (share * (2.0 ** 64 - 2.0 ** 13) - 2.0 ** 63).cast("long")
    # one row a label: broadcast if they are few enough
    bounds = size_checked_broadcast(sizes.select("lang", bound.alias("bound")), 64, n_rows=labels)
    ranked = (by_hash.join(bounds, "lang").where(F.col("h") <= F.col("bound"))
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h"))))
    limits = ranked.where(F.col("rank") <= sample_texts).groupBy("lang").agg(F.max("h").alias("limit"))
    limits = size_checked_broadcast(limits, 64, n_rows=labels)
    sample = known.join(limits, "lang").where(F.col("h") <= F.col("limit")).select("lang", "h", "text").dropDuplicates(["lang", "h"])
    counted = (sample.select("lang", "text").mapInArrow(_phrases, "lang string, phrase binary, n long")
               .groupBy("lang", "phrase").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc(F.col("n") * F.octet_length("phrase")), "phrase")
    upto = F.sum(F.octet_length("phrase") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))
    best = counted.withColumn("upto", upto).where(F.col("upto") < size).withColumn("rank", F.row_number().over(order))
    rows = best.select("lang", "rank", "phrase").collect()       # size bytes a label
    common = [r["lang"] for r in sizes.orderBy(F.desc("n"), "lang").collect()]
    phrases: dict[str, list[tuple[int, bytes]]] = {lang: [] for lang in common}
    for r in rows:
        phrases[r["lang"]].append((r["rank"], bytes(r["phrase"])))
    return [(lang, b" " + b" ".join(p for _, p in sorted(phrases[lang], reverse=True)) + b" ") for lang in common]


def with_language(docs: DataFrame, dictionaries: list[tuple[str, bytes]], text_col: str = "text",
                  min_margin: float = MIN_MARGIN, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` less ``without``, plus ``lang_pred, score, lang_rejected``.

    ``score`` is the relative margin ``1 - best / second`` (1 if only one label was
    learned); below ``min_margin`` the prediction is rejected.  Equal encodings give
    the commoner label.  A text that is null or has no letter, and every text if no
    label was learned, is ``und`` with score 0, rejected.  Repeated rows each come
    back; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def start():
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        coders = []
        for lang, content in shared.value:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            coders.append((lang, zstandard.ZstdCompressor(dict_data=d, compression_params=params)))

        def predict(raw: bytes | None) -> tuple[str, float]:
            text = letters_only(raw)
            if not text or not coders:
                return "und", 0.0
            blocks = [text[i:i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]
            sizes = sorted((sum(len(c.compress(b)) for b in blocks), k) for k, (_, c) in enumerate(coders))
            return coders[sizes[0][1]][0], 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [predict(raw) for raw in texts_as_bytes(batch, text_col)]
            scores = [s for _, s in found]
            return [pa.array([p for p, _ in found], pa.string()), pa.array(scores, pa.float64()),
                    pa.array([s < min_margin for s in scores], pa.bool_())]
        return compute

    return with_arrow_columns(docs, start, [("lang_pred", T.StringType()), ("score", T.DoubleType()),
                                            ("lang_rejected", T.BooleanType())], without)


@register("op1_language")
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a quarter of the ids is held out of learning.

    A null id is neither held out nor learned from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    learned = learn_dictionaries(docs.where(fold != 2))
    marked = docs.select("doc_id", "text", F.coalesce(fold == 2, F.lit(False)).alias("held_out"))
    return with_language(marked, learned, without=("text",))
