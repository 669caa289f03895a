"""From raw documents to token ids: five stages over the whole corpus.

Every stage takes what the one before kept, written as Parquet and read again, so
a lost executor never costs more than the stage at hand.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogrid.llm import bpe, decontaminate, line_dedup, quality, simhash
from chronogrid.session import materialise, prepare_workers


def _with_row(docs: DataFrame, *columns: str) -> DataFrame:
    """The whole row as one column, beside the columns that an operator reads: names can't clash."""
    return docs.select(F.struct("*").alias("_row"), *columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies within their language's limit (operator 4); the rest go.

    Documents without text stay; without trusted labels all stay."""
    prepare_workers(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trusted = quality.trusted_texts(docs, labels)
    return quality.classify(_with_row(docs, "text", "lang"), trusted).where(~F.col("rejected")).select("_row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents share stay in one of them only (operator 3); ``n_chars`` follows the text."""
    kept = line_dedup.drop_repeated_lines(_with_row(docs, "doc_id", "text"))
    columns = [F.col("text") if c == "text" else
               F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("_row.n_chars")).cast(docs.schema["n_chars"].dataType).alias(c)
               if c == "n_chars" else F.col("_row").getField(c).alias(c) for c in docs.columns]
    return kept.select(*columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: SimHashes of three-word shingles that differ in at most
    three bits link (operator 6, by its contract)."""
    prepare_workers(spark)
    return simhash.drop_near_duplicates(docs, words_per_shingle=3, max_bits=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates (operator 8); others stay as they are."""
    prepare_workers(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(_with_row(docs, "text"), items).where(~F.col("contaminated")).select("_row.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and a digest of what they decode to (operator 7)."""
    prepare_workers(spark)
    rows = docs.select("doc_id", "lang", "source", "text")
    return bpe.with_tokens(rows, bpe.public_tokenizer("word_bpe_49k.json"), decoded="decoded", without=("text",)).select(
        "doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe_encoding", token_stage),
]

#: Models, fingerprints and tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to token ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
