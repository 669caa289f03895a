"""Secrets in texts: named patterns, and windows of high entropy in candidate strings.

Three patterns give the base spans.  Beyond them every run of 24 or more characters that
keys are written in is a candidate.  In each of its stretches of one character class a
window slides one character at a time; its Shannon entropy follows from the counts of its
characters, of which a step changes two.  Windows at or above their class's limit whose
characters are mixed as that class asks join to spans.  An allow-list takes back entropy
spans: those of candidates that match a pattern of known harmless forms, or whose SHA-256
is listed.  Base spans stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import texts_as_bytes, with_arrow_columns
from .registry import register

#: Kinds in the order that breaks ties of position.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")     # runs are taken whole, so a least length in the pattern drops the same ones
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE = 8

#: Characters of a window.
WINDOW = 24
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
#: Class: its stretches, the least entropy in bits a character, what a window must hold one of each.
CLASSES = (
    ("hex", re.compile(r"[0-9a-f]{24,}|[0-9A-F]{24,}"), 3.01, (re.compile("[0-9]"), re.compile("[A-Fa-f]"))),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]{24,}"), 4.01, (re.compile("[0-9]"), re.compile("[A-Z]"), re.compile("[a-z]"))),
)
#: Whole candidates that are no secrets: parts of URLs and paths, numbered names, UUIDs, published digests of packages, placeholders.
ALLOWED = (
    r"/?(?:[A-Za-z]{1,20}[0-9]{0,4}[/_-])+[A-Za-z]{0,20}[0-9]{0,4}",
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"sha(?:1|256|384|512)-[A-Za-z0-9+/]+=*",
    r"(?i:.*(?:example|placeholder|your_?key|xxxxxx|000000|abcdef0?123456|0123456789abcdef).*)",
)

#: c * log2(c) of a character's count in a window.
WEIGHT = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def entropy_spans(s: str, window: int = WINDOW) -> list[tuple[int, int, float]]:
    """Stretches (start, end, highest entropy) of a candidate that windows of high entropy cover."""
    marked: list[tuple[int, int, float]] = []
    for _, stretch, least, mixed in CLASSES:
        # entropy >= least  <=>  the sum of c * log2(c) is small enough
        most = window * (math.log2(window) - least)
        for m in stretch.finditer(s):
            a, b = m.span()
            counts: dict[str, int] = {}
            total = 0.0
            run: list | None = None
            # each mixed class: how many of its characters the window holds
            kinds = [[1 if p.match(c) else 0 for c in s[a:b]] for p in mixed]
            held = [0] * len(kinds)
            for k in range(a, b):
                if k - a >= window:
                    old = s[k - window]
                    n = counts[old]
                    counts[old] = n - 1
                    total += WEIGHT[n - 1] - WEIGHT[n]
                    for i, kind in enumerate(kinds):
                        held[i] -= kind[k - window - a]
                n = counts.get(s[k], 0)
                counts[s[k]] = n + 1
                total += WEIGHT[n + 1] - WEIGHT[n]
                for i, kind in enumerate(kinds):
                    held[i] += kind[k - a]
                if k - a + 1 >= window and total <= most and all(held):
                    start, bits = k + 1 - window, math.log2(window) - total / window
                    if run is not None and start <= run[1]:
                        run[1], run[2] = k + 1, max(run[2], bits)
                    else:
                        if run is not None:
                            marked.append(tuple(run))
                        run = [start, k + 1, bits]
            if run is not None:
                marked.append(tuple(run))
    marked.sort()
    joined: list[tuple[int, int, float]] = []
    for start, end, bits in marked:
        if joined and start <= joined[-1][1]:
            joined[-1] = joined[-1][0], max(end, joined[-1][1]), max(bits, joined[-1][2])
        else:
            joined.append((start, end, bits))
    return joined


def _scanner(patterns: Iterable[str], digests: Iterable[str]) -> Callable[[str], list[tuple[str, int, int, float | None]]]:
    allowed, known = [re.compile(p) for p in patterns], frozenset(digests)

    def scan(text: str) -> list[tuple[str, int, int, float | None]]:
        """Spans of a text by start, then kind as listed."""
        found = [(m.start(), 0, m.end(), None) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= LEAST_VALUE]
        found += [(m.start(), 1, m.end(), None) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end(), None) for m in HEX.finditer(text)]
        for m in CANDIDATE.finditer(text):
            s = m.group()
            spans = entropy_spans(s)
            if spans and not any(p.fullmatch(s) for p in allowed) and (not known or hashlib.sha256(s.encode()).hexdigest() not in known):
                found += [(m.start() + a, 3, m.start() + b, bits) for a, b, bits in spans]
        found.sort(key=lambda x: x[:2])
        return [(KINDS[kind], start, end, bits) for start, kind, end, bits in found]
    return scan


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("entropy", T.DoubleType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("entropy", pa.float64())]))


def with_secrets(docs: DataFrame, text_col: str = "text", secrets: str = "secrets", masked: str | None = None,
                 allowed: Iterable[str] = ALLOWED, allowed_sha256: Iterable[str] = (), without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` less ``without``, plus ``secrets``: the spans of each whole text (kind, start, end, entropy).

    Positions are code points, ends exclusive; spans come by start, then kind.  Kinds are
    ``assign`` (a value of 8 or more characters given to a name), ``access`` (an access key
    id), ``hex`` (32 or more hex digits) and ``entropy`` (the only one with bits a character).
    ``allowed`` are patterns that a whole candidate matches, ``allowed_sha256`` digests of
    single candidates (a short list kept by people; it goes to every task): they suppress
    entropy spans only.  With ``masked``, a column of that name holds the text with every
    character of a span replaced by ``*``.  A null or empty text has no spans (masked: the
    same).  Repeated rows each come back; an empty table gives no rows; input columns named
    like the outputs give way to them."""
    patterns, digests = tuple(allowed), tuple(allowed_sha256)

    def start():
        scan = _scanner(patterns, digests)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            rows, texts = [], []
            for raw in texts_as_bytes(batch, text_col):
                text = (raw or b"").decode()
                found = scan(text)
                rows.append([{"kind": kind, "start": a, "end": b, "entropy": bits} for kind, a, b, bits in found])
                if masked:
                    pieces, at = [], 0
                    for _, a, b, _ in found:
                        if b > at:
                            pieces += [text[at:max(a, at)], "*" * (b - max(a, at))]
                            at = b
                    texts.append(None if raw is None else "".join(pieces) + text[at:])
            return [pa.array(rows, _ARROW)] + [pa.array(texts, pa.string())] * bool(masked)
        return compute

    fields = [(secrets, SPANS)] + [(masked, T.StringType())] * bool(masked)
    return with_arrow_columns(docs, start, fields, without)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _sql_matches(pattern: str, where: str, kind: str, rank: int) -> str:
    """Matches with positions: every piece of the text is a match or one character, so lengths add up to starts."""
    return f"""SELECT doc_id, k, '{kind}' AS kind, {rank} AS r, s, s + length(x) AS e, x FROM (
  SELECT doc_id, k, x, coalesce(sum(length(x)) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s
  FROM (SELECT doc_id, k, unnest(pieces) AS x, generate_subscripts(pieces, 1) AS i
        FROM (SELECT doc_id, k, regexp_extract_all(text, '{pattern}|(?s:.)') AS pieces FROM d)))
  WHERE length(x) > 1 AND {where}"""


_ASSIGN_SQL = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
_VALUE_SQL = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_CLASS_SQL = {"hex": ("[0-9a-f]{24,}|[0-9A-F]{24,}", "[0-9]", "[A-Fa-f]", "."), "base64": ("[A-Za-z0-9+/_=-]{24,}", "[0-9]", "[A-Z]", "[a-z]")}
_WINDOWS_SQL = " UNION ALL ".join(f"""SELECT doc_id, k, cs, s + w - 1 AS a, least_bits FROM (
  SELECT doc_id, k, cs, s, x, unnest(range(1, length(x) - {WINDOW - 2})) AS w, {least} AS least_bits FROM (
    SELECT doc_id, k, cs, x, cs + coalesce(sum(length(x)) OVER (PARTITION BY k, cs ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s
    FROM (SELECT doc_id, k, s AS cs, unnest(pieces) AS x, generate_subscripts(pieces, 1) AS i
          FROM (SELECT doc_id, k, s, regexp_extract_all(x, '{_CLASS_SQL[name][0]}|(?s:.)') AS pieces FROM candidates))) WHERE length(x) >= {WINDOW})
  WHERE list_entropy(split(substr(x, w, {WINDOW}), '')) >= least_bits AND regexp_matches(substr(x, w, {WINDOW}), '{_CLASS_SQL[name][1]}')
    AND regexp_matches(substr(x, w, {WINDOW}), '{_CLASS_SQL[name][2]}') AND regexp_matches(substr(x, w, {WINDOW}), '{_CLASS_SQL[name][3]}')"""
                               for name, _, least, _ in CLASSES)
ORACLE_SQL = f"""WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS text FROM documents),
base AS MATERIALIZED ({_sql_matches(_ASSIGN_SQL, f"length(regexp_extract(x, '{_VALUE_SQL}', 1)) >= {LEAST_VALUE}", 'assign', 0)}
  UNION ALL {_sql_matches('AKIA[A-Z0-9]+', 'length(x) >= 16', 'access', 1)}
  UNION ALL {_sql_matches('[0-9a-f]+', 'length(x) >= 32', 'hex', 2)}),
candidates AS MATERIALIZED (SELECT doc_id, k, s, x FROM ({_sql_matches('[A-Za-z0-9+/_=-]{24,}', 'length(x) >= 24', 'entropy', 3)})
  WHERE {" AND ".join(f"NOT regexp_full_match(x, '{p}')" for p in ALLOWED)}),
w AS MATERIALIZED (SELECT DISTINCT doc_id, k, cs, a FROM ({_WINDOWS_SQL})),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY k, cs ORDER BY a) AS grp
  FROM (SELECT *, CASE WHEN a - lag(a) OVER (PARTITION BY k, cs ORDER BY a) <= {WINDOW} THEN 0 ELSE 1 END AS fresh FROM w)),
spans AS (SELECT k, kind, r, s, e FROM base UNION ALL SELECT k, 'entropy', 3, min(a), max(a) + {WINDOW} FROM g GROUP BY k, cs, grp),
n AS (SELECT k, count(*) FILTER (r = 0) AS n_assign, count(*) FILTER (r = 1) AS n_access, count(*) FILTER (r = 2) AS n_hex,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r) FILTER (r < 3), '') AS base,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r) AS spans FROM spans GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN n ON n.k = d.k"""


@register("op12_secrets", ORACLE_SQL)
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base spans, their digest and all spans of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_secrets(docs, without=("text",))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"))
