"""Quality classification by an interpolated modified Kneser-Ney n-gram model.

The model is trained on all trusted text, and its units are the code units of the
texts themselves (``kneser_ney.py``): counts are sharded tables, and documents get
their perplexity by joins of their n-grams with them.

A document is rejected when its perplexity lies above a quantile of the trusted
documents of its language, each scored by a model that hasn't seen it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import size_checked_broadcast
from ..session import materialise
from .kneser_ney import ORDER, Counter, count_units, estimate, numbered, with_perplexity  # noqa: F401
from .registry import register
from .symbols import SYMBOLS, TABLE, count_symbols, dense_bits, dense_models, grams  # noqa: F401

#: Documents above this quantile of the trusted documents' perplexity are rejected.
QUANTILE = 0.995
#: Distinct trusted texts from which a language has a model and threshold of its own: the
#: largest of fewer perplexities would reject more than 1 % of the clean documents.
LEAST_TEXTS = 100
#: Model of languages without trusted text: that of all trusted text.
POOLED = ""
#: Between the language and the fold in a model's name.
HALF = "\x1f"


def _fold(text: str) -> Column:
    """Equal texts are in one fold."""
    return F.pmod(F.xxhash64(text), F.lit(2))


def count_models(trusted: DataFrame, count: Counter = count_units) -> DataFrame:
    """``lang, gram, c`` of the models of ``lang, text``.

    There is one of each language and one of all text, and beside each two halves:
    that named ``HALF`` and a fold is trained without the texts of the fold."""
    counts = count(trusted.select(F.concat("lang", F.lit(HALF), _fold("text").cast("string")).alias("lang"), "text"))
    counts = materialise(counts.select(F.split_part("lang", F.lit(HALF), F.lit(1)).alias("lang"),
                                       F.split_part("lang", F.lit(HALF), F.lit(2)).alias("fold"), "gram", "c"), "counts")
    pooled = counts.where(F.col("lang") != POOLED).select(F.lit(POOLED).alias("lang"), "fold", "gram", "c")
    counts = counts.unionByName(pooled)
    others = counts.select(F.concat("lang", F.lit(HALF), F.when(F.col("fold") == "0", "1").otherwise("0")).alias("lang"), "gram", "c")
    return counts.select("lang", "gram", "c").unionByName(others).groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def train(trusted: DataFrame) -> dict:
    """The same models over the bounded alphabet of ``symbols.py``, as arrays."""
    return dense_models(*estimate(count_models(trusted, count_symbols), SYMBOLS))


def trusted_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """``lang, text`` of the documents labelled good (quality 1) and not toxic by all their labels."""
    good = (labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
            .where("q = 1 AND t = 0").select(F.col("doc_id").alias(id_col)))
    good = materialise(good, "trusted")
    rows = docs.select(id_col, F.coalesce(F.col(lang_col), F.lit(POOLED)).alias("lang"), F.col(text_col).alias("text"))
    return rows.join(size_checked_broadcast(good, 16), id_col, "left_semi").select("lang", "text")


def classify(docs: DataFrame, trusted: DataFrame, text_col: str = "text", lang_col: str = "lang",
             quantile: float = QUANTILE, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` less ``without``, plus ``n_symbols, perplexity, threshold, rejected``.

    ``trusted`` (``lang, text``) trains the model; all of it counts.  Languages with
    fewer than ``LEAST_TEXTS`` distinct trusted texts, a null one included, are held
    against the model and threshold of all trusted text; where their own trusted texts
    exceed that threshold, against the largest of theirs.  Every perplexity behind a
    threshold is that of a model that hasn't seen the text; where there is none, as all
    trusted texts are in one fold, no document is rejected.  A null or empty text has no
    perplexity and is not rejected, nor is any document where there is no trusted text.
    Repeated rows each come back; an empty table gives no rows."""
    fold, text = _fold("text"), F.xxhash64("text")
    distinct = trusted.where("text <> ''").groupBy("lang").agg(*[F.count_distinct(F.when(fold == k, text)).alias(f"n{k}") for k in (0, 1)])
    own = [r["lang"] for r in distinct.collect() if r["lang"] != POOLED and r["n0"] + r["n1"] >= LEAST_TEXTS and min(r["n0"], r["n1"]) > 0]
    is_own = F.col("lang").isin(own)
    model = numbered(*estimate(count_models(trusted.select(F.when(is_own, F.col("lang")).otherwise(POOLED).alias("lang"), "text"))))
    # held out: every trusted text is scored by the models of the other half, its language's and that of all
    held = lambda lang: F.concat(lang, F.lit(HALF), fold.cast("string"))
    halves = trusted.select("lang", "text", held(F.lit(POOLED)).alias("half"), F.when(is_own, held(F.col("lang"))).alias("own_half"))
    scored = with_perplexity(halves, model, "text", {"by_all": "half", "by_own": "own_half"}, ("text", "half", "own_half"),
                             keep_as="scored", step=materialise)
    limit = lambda c: F.percentile_approx(c, F.lit(quantile), F.lit(100_000)).alias("limit")
    every = scored.agg(limit("by_all")).first()["limit"]
    limits = {r["lang"]: r["limit"] for r in scored.where("by_own IS NOT NULL").groupBy("lang").agg(limit("by_own")).collect()}
    rare = scored.where(F.col("by_all").isNotNull() & ~is_own & (F.col("lang") != POOLED)).groupBy("lang").agg(F.max("by_all").alias("limit"))
    limits |= {r["lang"]: max(r["limit"], every) for r in rare.collect()}
    limits[POOLED] = every
    # one number a language
    table = F.create_map(*[F.lit(x) for lang in sorted(limits) for x in (lang, limits[lang])]).cast("map<string,double>")
    threshold = F.coalesce(F.try_element_at(table, F.coalesce(F.col(lang_col), F.lit(POOLED))), F.lit(limits[POOLED]).cast("double"))
    whole = model._replace(names={x: k for x, k in model.names.items() if HALF not in x})
    return (with_perplexity(docs, whole, text_col, {"perplexity": lang_col}, without, POOLED, step=materialise).withColumn("threshold", threshold)
            .withColumn("rejected", F.coalesce(F.col("perplexity") > F.col("threshold"), F.lit(False))))


@register("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity, threshold and decision of every document; trained on all trusted documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, trusted_texts(docs, labels), without=("text",))
