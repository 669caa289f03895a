"""Removal of lines that repeat across documents (native).

Lines are normalised to keys, exploded with their position and hashed (two
independent 64-bit hashes); documents per hash are counted in two partial steps,
so a line that stands in a third of all documents never meets in one task before
it has been reduced to one row per task.  Positions to drop come back per
document and the text is put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import salted_join
from .registry import register

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased (other letters stay)."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(line) == F.length(line), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                        min_docs: int = 5) -> DataFrame:
    """``docs`` with ``text_col`` replaced and ``n_lines``, ``n_dropped`` added.

    A key of ``min_chars`` code points or more that stands in ``min_docs``
    documents or more keeps its lines only in the document of the largest id.
    All other columns stay.  A text that is null or empty is one empty line;
    nothing is dropped from it and a null stays null.  A null id counts as no
    document and is never the largest, so such a row loses the lines that
    ``min_docs`` other documents share.  Rows that share an id are one document.
    Without repeated lines every text comes back unchanged; an empty table gives
    no rows.  Input columns named like the two counts give way to them."""
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    mark = [F.xxhash64(F.lit(1), F.col(text_col)), F.xxhash64(F.lit(2), F.col(text_col))]

    hashed = F.transform(F.transform(split, line_key), lambda k, i: F.when(
        F.length(k) >= min_chars, F.struct(i.alias("pos"), F.xxhash64(F.lit(1), k).alias("h1"), F.xxhash64(F.lit(2), k).alias("h2"))))
    seen = (docs.select(F.col(id_col).alias("id"), mark[0].alias("m1"), mark[1].alias("m2"),
                        F.explode(F.filter(hashed, lambda s: s.isNotNull())).alias("s"))
            .select("id", "m1", "m2", "s.pos", "s.h1", "s.h2"))
    shared = (seen.where(F.col("id").isNotNull()).select("h1", "h2", "id").distinct()
              .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
              .where(F.col("n") >= min_docs).drop("n"))
    # a line of very many documents is spread by their ids
    drops = (salted_join(seen, shared, ["h1", "h2"], F.xxhash64("id", "m1"))
             .where(~F.col("id").eqNullSafe(F.col("keeper")))
             .groupBy("id", "m1", "m2").agg(F.collect_set("pos").alias("_drop")))

    d = docs.alias("d")
    r = drops.alias("r")
    same = (F.col(f"d.{id_col}").eqNullSafe(F.col("r.id")) & (F.xxhash64(F.lit(1), F.col(f"d.{text_col}")) == F.col("r.m1"))
            & (F.xxhash64(F.lit(2), F.col(f"d.{text_col}")) == F.col("r.m2")))
    lines = F.split(F.coalesce(F.col(f"d.{text_col}"), F.lit("")), "\n", -1)
    kept_at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("r._drop"))
    kept = F.when(F.col("r._drop").isNull(), F.col(f"d.{text_col}")).otherwise(
        F.array_join(F.transform(kept_at, lambda i: F.get(lines, i)), "\n"))
    return d.join(r, same, "left").select(
        *[kept.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in columns],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("r._drop"), F.lit(0)).cast("long").alias("n_dropped"))


ORACLE_SQL = f"""WITH l AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), '{UPPER}', '{LOWER}') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
s AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.doc_id, l.pos, l.line, (s.k IS NOT NULL AND l.doc_id <> s.keeper) AS gone FROM l LEFT JOIN s ON l.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@register("op3_line_dedup", ORACLE_SQL)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts, dropped lines and a digest of the kept text of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"), 256).alias("kept_sha256"))
