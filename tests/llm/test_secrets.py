"""Secret scans against plain regular expressions and directly counted entropies."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import pytest

from chronogrid.llm import registered, secrets

TOKEN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base(text):
    found = []
    for m in re.finditer(TOKEN, text, re.I | re.A):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    for rank, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 16), (2, "hex", "[0-9a-f]+", 32)):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def entropy(s):
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def covered(s):
    """Positions of a candidate in windows of high entropy, each counted from scratch."""
    marked = set()
    for chars, least, need in (("0123456789abcdef", 3.01, ("0-9", "a-f")), ("0123456789ABCDEF", 3.01, ("0-9", "A-F")),
                               (None, 4.01, ("0-9", "A-Z", "a-z"))):
        for k in range(len(s) - 23):
            w = s[k:k + 24]
            if (chars is None or set(w) <= set(chars)) and entropy(w) >= least and all(re.search(f"[{n}]", w) for n in need):
                marked |= set(range(k, k + 24))
    return marked


def random_key(rng):
    letters = rng.choice(["0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
                          "abcdefg", "01"])
    return "".join(rng.choice(letters) for _ in range(rng.choice([10, 24, 25, 40, 64])))


@pytest.mark.parametrize("seed", range(60))
def test_windows(seed):
    rng = random.Random(seed)
    s = "".join(random_key(rng) for _ in range(rng.randint(1, 4)))
    spans = secrets.entropy_spans(s)
    assert {k for a, b, _ in spans for k in range(a, b)} == covered(s)
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    for a, b, bits in spans:
        assert bits <= max(entropy(s[k:k + 24]) for k in range(a, b - 23)) + 1e-9


def test_limits_are_never_met_exactly():
    """No window's entropy lies within rounding of a limit, so any order of summing decides alike."""
    def parts(n, most):
        if n == 0:
            yield ()
        for k in range(min(n, most), 0, -1):
            for rest in parts(n - k, k):
                yield (k, *rest)
    values = {round(math.log2(24) - sum(c * math.log2(c) for c in p) / 24, 12) for p in parts(24, 24)}
    assert min(abs(v - least) for v in values for least in (3.01, 4.01)) > 1e-6


KEY = "q7Rz" "K2mPx9Lw" "4TbVn8Yc" "3HsJd6Fg"
TEXTS = ["", None, "password: hunter2", "PASSWORD = 'hunter2hunter2' and token=token=abcdefghij", "secret: passwd: abcdefgh",
         "é🙂 api_key:\"abcd.efgh\" apikey = x", "AKIA" + "A" * 12 + " AKIAAKIA12345678 AKIASHORT xAKIA" + "Z9" * 8,
         "f" * 31 + " " + "0a" * 16 + "g" + "0123456789abcdef" * 3, "x" + KEY + "\n" + KEY.lower(), "tokenſ = abcdefghijk Key",
         "see /usr/local/lib/python3/site_packages/numpy/core/include or 123e4567-e89b-12d3-a456-426614174000",
         "sha256-" + KEY + "= your_key" + KEY, "A1b2" * 20_000, ("lorem ipsum " * 5000) + KEY, "key\x00" + KEY + "\r\n\tnext"]


def documents(ready):
    rows = [(i, t, "s", 1) for i, t in enumerate(TEXTS)] + [(None, KEY, "s", 1), (2, KEY, "s", 1), (2, KEY, "s", 1)]
    return rows, ready.createDataFrame(rows, "doc_id long, text string, secrets string, kind int")


def test_spans(ready):
    rows, docs = documents(ready)
    got = secrets.with_secrets(docs, masked="masked").collect()
    assert [r.doc_id for r in got] == [r[0] for r in rows] and got[0].kind == 1
    for r in got:
        spans = [(s.kind, s.start, s.end) for s in r.secrets]
        assert [s for s in spans if s[0] != "entropy"] == base(r.text or "")
        hidden = {k for _, a, b in spans for k in range(a, b)}
        assert r.masked == (None if r.text is None else "".join("*" if k in hidden else c for k, c in enumerate(r.text)))
    by_id = {r.doc_id: [(s.kind, s.start, s.end) for s in r.secrets] for r in got}
    assert by_id[8] == [("entropy", 1, 29)] or by_id[8][0] == ("entropy", 0, 29)
    assert by_id[10] == [] and by_id[11] == []
    assert by_id[13][-1][0] == "entropy" and by_id[13][-1][2] == 60_000 + len(KEY)


def test_allow_list_takes_back_entropy_only(ready):
    docs = ready.createDataFrame([(1, f"token = {KEY} and {KEY}")], "doc_id long, text string")
    kinds = lambda **more: [s.kind for s in secrets.with_secrets(docs, **more).first().secrets]
    assert kinds() == ["assign", "entropy", "entropy"]
    assert kinds(allowed_sha256=[hashlib.sha256(KEY.encode()).hexdigest()]) == ["assign"]
    assert kinds(allowed=["q7.*"]) == ["assign"]


def test_sql_on_awkward_texts(ready, tables):
    rows, _ = documents(ready)
    rows = [(i, (t or "")[:3000] if t else t, "en", "s", 1) for i, t, *_ in rows if "\x00" not in (t or "")]
    folder = tables(documents=(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    got = registered.QUERIES["op12_secrets"](ready, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    found = con.execute(f"SELECT {', '.join(got.columns)} FROM ({registered.ORACLE['op12_secrets']})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, found))
