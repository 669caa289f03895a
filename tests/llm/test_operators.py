"""The operators against brute force, round trips and held-out accuracy."""

import base64
import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chronogrid.llm import bpe, components, decontaminate, html_text, kneser_ney, language, line_dedup, nearest, quality, registered, sharding, simhash, warc

SF = "/root/testdata/sf0.01"


# --- language -----------------------------------------------------------------
def test_language_held_out_accuracy(ready):
    truth = {r.doc_id: (r.lang, r.text) for r in ready.read.parquet(f"{SF}/documents.parquet").collect()}
    got = registered.QUERIES["op1_language"](ready, SF).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_awkward(awkward):
    learned = [("en", b" the quick brown fox jumps over the lazy dog one line that is long enough " * 20),
               ("de", " das ist eine lange zeile mit größe und viel deutschem text ".encode() * 20)]
    got = language.with_language(awkward, learned).collect()
    assert len(got) == 9 and got[0]["lang_pred"] == "en" and got[0]["n_lines"] == "n"
    none = [r for r in got if not any(c.isalpha() for c in r.text or "")]
    assert len(none) == 3 and all((r.lang_pred, r.score, r.lang_rejected) == ("und", 0.0, True) for r in none)
    assert {r.lang_pred for r in language.with_language(awkward, []).collect()} == {"und"}


# --- WARC ---------------------------------------------------------------------
def test_archive_round_trip(ready, tmp_path):
    rows = [(i, f"http://x/{i}", f"<p>{'same' if i % 3 == 0 else i} é</p>" * (1 + i % 5)) for i in range(300)] + [(300, None, None), (301, "a\r\nb", "")]
    pages = ready.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    folder, written = warc.archive_pages(pages, str(tmp_path / "archives"))
    back = {r.page_id: r for r in warc.read_archives(ready, folder, written).collect()}
    assert len(back) == 302
    newest = {}
    for i, _, h in rows:
        newest[h or ""] = max(i, newest.get(h or "", -1))
    for i, url, h in rows:
        payload, r = (h or "").encode(), back[i]
        keeper = newest[h or ""]
        assert r.record_type == ("response" if keeper == i else "revisit")
        assert r.refers_to == (None if keeper == i else keeper)
        assert (r.payload is None) == (keeper != i) and (r.payload is None or bytes(r.payload) == payload)
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_archives_not_reported_are_not_read(ready, tmp_path):
    pages = ready.createDataFrame([(1, "u", "a"), (2, "u", "b")], "page_id long, url string, html string")
    folder, written = warc.archive_pages(pages, str(tmp_path / "archives"))
    (tmp_path / "archives" / "part-lost.warc.zst").write_bytes(b"half an archive")
    assert warc.read_archives(ready, folder, written).count() == 2


def _archive(records, dictionary=b""):
    import zstandard
    coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return warc.dictionary_frame(dictionary) + b"".join(coder.compress(r) for r in records)


def test_reader_validates():
    payload = b"<p>x</p>" * 100
    good = warc.encode_record("response", 7, "u", payload, warc.digest(payload), len(payload), None)
    found = list(warc.read_archive(_archive([good, good])))
    assert [r["page_id"] for r in found] == [7, 7] and found[0]["payload"] == payload
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"<p>", b"<q>"),
                good.replace(b"WARC-Date", b"X-Date"), good + b"more"):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(_archive([bad])))
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(_archive([good])[8:]))
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(_archive([good])[:-9]))


def test_dictionary_is_loaded_from_the_leading_frame():
    import zstandard
    rng = random.Random(2)
    samples = [" ".join(rng.choices(["alpha", "beta", "gamma", "<p>", "</p>"], k=400)).encode() for _ in range(400)]
    trained = warc.train_dictionary(samples, 4096)
    record = warc.encode_record("response", 1, "u", samples[0], warc.digest(samples[0]), len(samples[0]), None)
    raw = _archive([record], trained)
    assert next(warc.read_archive(raw))["payload"] == samples[0]
    packed = zstandard.ZstdCompressor().compress(trained)  # the frame may hold it compressed
    again = warc.dictionary_frame(packed) + raw[8 + len(trained):]
    assert next(warc.read_archive(again))["payload"] == samples[0]


# --- lines --------------------------------------------------------------------
def brute_lines(rows, min_chars, min_docs):
    lower = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)
    key = lambda x: x.strip(line_dedup.BLANKS).translate(lower)
    where = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars and i is not None:
                where.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(where.get(key(x), ())) < min_docs or i == max(where[key(x)])]
        out.append((i, "\n".join(kept) if t is not None or len(kept) < len(lines) else None, len(lines), len(lines) - len(kept)))
    return out


def test_lines_against_brute_force(ready):
    rng = random.Random(1)
    lines = ["", "Ab", " aB\t", "ÀB", "cd ef", "CD EF", "x", "\x0bx\x0c", "é" * 3, "É" * 3]
    rows = [(i if i % 11 else None, None if i % 17 == 0 else "\n".join(rng.choices(lines, k=rng.randint(0, 6)))) for i in range(200)]
    rows += rows[:20]
    got = line_dedup.drop_repeated_lines(ready.createDataFrame(rows, "doc_id long, text string"), min_chars=2, min_docs=3)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute_lines(rows, 2, 3)))


def test_lines_awkward(awkward):
    got = line_dedup.drop_repeated_lines(awkward, min_docs=2).collect()
    assert len(got) == 9 and sorted(r.n_dropped for r in got) == [0] * 7 + [1, 1]
    assert {(r.doc_id, r.text) for r in got if r.n_dropped} == {(1, "short"), (None, "")}


# --- quality ------------------------------------------------------------------
def brute_kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney, straight from the definition."""
    symbols = [[0] * (order - 1) + [int(quality.TABLE[min(ord(c), 65535)]) for c in t] for t in texts]
    counts = [None] * (order + 1)
    counts[order] = Counter(tuple(s[i:i + order]) for s in symbols for i in range(len(s) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cuts = [None] * (order + 1)
    for n in range(1, order + 1):
        k = Counter(counts[n].values())
        y = k[1] / (k[1] + 2 * k[2]) if k[1] else 0.5
        cuts[n] = [min(max(i - (i + 1) * y * k[i + 1] / k[i] if k[i] else i * 0.5, 0.05), i - 0.05) for i in (1, 2, 3)]

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / quality.SYMBOLS
        same = {h: c for h, c in counts[n].items() if h[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        cut = lambda c: cuts[n][min(c, 3) - 1]
        total, own = sum(same.values()), counts[n].get(g, 0)
        return ((own - cut(own) if own else 0) + sum(map(cut, same.values())) * p(g[1:])) / total
    return p


def test_model_against_its_definition(ready):
    texts = ["the cat sat. on the mat", "The dog, the cat", "a b\n9", "cat"]
    models = quality.train(ready.createDataFrame([("en", t) for t in texts], "lang string, text string"))
    bits = quality.dense_bits(models["en"])
    p = brute_kneser_ney(texts, quality.ORDER)
    for text in (*texts, "new words! ÿ", "dog"):
        for g in next(quality.grams(text.encode())):
            digits, rest = [], int(g)
            for _ in range(quality.ORDER):
                digits.append(rest % quality.SYMBOLS)
                rest //= quality.SYMBOLS
            assert bits[g] == pytest.approx(-np.log2(p(tuple(reversed(digits)))), rel=1e-4)
    # the probabilities of all symbols after a context add up to one
    assert np.allclose((2.0 ** -bits.astype(float)).reshape(-1, quality.SYMBOLS).sum(axis=1), 1, atol=1e-4)


def code_units(text):
    """A text whose characters are the UTF-16 code units of another."""
    return "".join(chr(u) for u in np.frombuffer(text.encode("utf-16-le"), "<u2"))


@pytest.mark.parametrize("block", [1, 1 << 24])
def test_perplexity_of_real_units_against_the_definition(ready, monkeypatch, block):
    texts = ["The cat sat. on the mat", "кот сидел на коврике", "猫坐在垫子上 🙂🙃", "ABC 123 abc", "кот", "A\ud7ff\ue000\uffff"]
    docs = [*texts, None, "", "Кот, кошка", "狗 🙂", "xyz 123", "the dog"]
    monkeypatch.setattr(kneser_ney, "BLOCK", block)  # a row each, or all of a partition in one
    rows = [(k, t, "xx") for k, t in enumerate(docs)]
    got = {r.doc_id: r for r in quality.classify(ready.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2),
                                                 ready.createDataFrame([("en", t) for t in texts], "lang string, text string")).collect()}
    monkeypatch.setattr(quality, "TABLE", np.arange(1 << 16))
    monkeypatch.setattr(quality, "SYMBOLS", 1 << 16)
    p = brute_kneser_ney([code_units(t) for t in texts], quality.ORDER)
    assert len(got) == len(docs)
    for k, t in enumerate(docs):
        s = [0] * (quality.ORDER - 1) + [ord(c) for c in code_units(t or "")]
        bits = -sum(math.log2(p(tuple(s[i:i + quality.ORDER]))) for i in range(len(s) - quality.ORDER + 1))
        assert got[k].n_symbols == len(t or "")
        assert got[k].perplexity == (pytest.approx(2 ** (bits / len(t)), rel=1e-6) if t else None)


def test_letters_beyond_ascii_capitals_and_digits_are_told_apart(ready):
    rng = random.Random(5)
    lexicon = {"ru": ["река", "дом", "идёт", "зелёный", "часто", "под", "камень", "хлеб"], "en": ["RIVER", "HOUSE", "1984", "2001", "STONE", "GREEN"]}
    prose = lambda lang: " ".join(rng.choice(lexicon[lang]) for _ in range(80))
    # every character has the class of the one it stands for, in a table of classes
    swapped = {"ru": lambda t: "".join(c if c == " " else chr(ord(c) ^ 4) for c in t), "en": lambda t: "".join(c if c == " " else rng.choice("0123456789" if c.isdigit() else "QXZJVK") for c in t)}
    trusted = [(lang, prose(lang)) for lang in lexicon for _ in range(150)]
    docs = [(k, prose(lang), lang) for k, lang in enumerate(["ru", "en"] * 40)] + [(100 + k, swapped[lang](prose(lang)), lang) for k, lang in enumerate(["ru", "en"] * 5)]
    got = quality.classify(ready.createDataFrame(docs, "doc_id long, text string, lang string"), ready.createDataFrame(trusted, "lang string, text string")).collect()
    gone = {r.doc_id for r in got if r.rejected}
    assert set(range(100, 110)) <= gone and sum(i < 100 for i in gone) <= 3


def test_no_model_is_broadcast_or_collected(ready):
    counts = quality.count_models(ready.createDataFrame([("en", "some words of a text"), ("en", "others")], "lang string, text string"))
    model = kneser_ney.numbered(*kneser_ney.estimate(counts))
    with_threshold = ready.conf.get("spark.sql.autoBroadcastJoinThreshold")
    ready.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of real size
    try:
        scored = kneser_ney.with_perplexity(ready.createDataFrame([("some text", "en")], "text string, lang string"), model, "text", {"perplexity": "lang"})
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert scored.first()["perplexity"] > 1
    finally:
        ready.conf.set("spark.sql.autoBroadcastJoinThreshold", with_threshold)
    # but for the discounts, one row a model and order
    assert plan.count("SortMergeJoin") >= 3 * kneser_ney.ORDER and plan.count("BroadcastExchange") <= kneser_ney.ORDER


def test_texts_are_not_shuffled_and_every_order_is_joined(ready, monkeypatch):
    counts = quality.count_models(ready.createDataFrame([("en", "some words of a text"), ("en", "others")], "lang string, text string"))
    model = kneser_ney.numbered(*kneser_ney.estimate(counts))
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    docs = ready.createDataFrame([("some text", "en"), ("other", "en"), (None, "en")], "text string, lang string")
    written = []
    with_threshold = ready.conf.get("spark.sql.autoBroadcastJoinThreshold")
    ready.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def step(df, name):
            written.append(plan_of(df))
            return kneser_ney.materialise(df, name)

        scored = kneser_ney.with_perplexity(docs, model, "text", {"perplexity": "lang"}, step=step)
        plan = plan_of(scored)
        got = scored.collect()
    finally:
        ready.conf.set("spark.sql.autoBroadcastJoinThreshold", with_threshold)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan  # that of the answers
    assert sum(p.count("SortMergeJoin") for p in written) >= 3 * kneser_ney.ORDER and not any("BroadcastExchange" in p for p in written)
    assert sorted(r.perplexity is None for r in got) == [False, False, True]
    assert not [t for t in ready.catalog.listTables() if t.name.startswith("blocks_")]


def test_rows_of_any_type_come_back_as_they_are(ready):
    docs = ready.sql("""SELECT id AS doc_id, concat('some words ', id) AS text, 'en' AS lang, array(id, null) AS a, map('k', id) AS m,
        named_struct('d', cast(id AS decimal(20,3)), 't', timestamp'2024-01-01 00:00:00', 'n', timestamp_ntz'2024-01-01 00:00:00',
        'x', cast(null AS date), 'b', cast('b' AS binary)) AS s, cast(id AS smallint) AS i, cast(id AS float) AS f, 0 AS perplexity FROM range(40)""")
    trusted = ready.createDataFrame([("en", f"some words of a text {k}") for k in range(20)], "lang string, text string")
    whole = docs.select(F.struct("*").alias("_row"), "text", "lang")
    got = quality.classify(whole, trusted).select("_row.*")
    assert got.schema.simpleString() == docs.schema.simpleString()
    assert sorted(got.collect(), key=lambda r: r.doc_id) == docs.orderBy("doc_id").collect()


def test_writes_leave_no_shuffle_files(ready):
    from chronogrid.session import SHUFFLE_CLEANUP, materialise
    tracker = ready._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before, was = set(str(tracker.shuffleStatuses().keys()).split("Set(")[-1].rstrip(")").split(", ")), ready.conf.get(SHUFFLE_CLEANUP, "false")
    kept = materialise(ready.range(1000).groupBy(F.col("id") % 7).count(), "t")
    after = set(str(tracker.shuffleStatuses().keys()).split("Set(")[-1].rstrip(")").split(", "))
    assert kept.count() == 7 and ready.conf.get(SHUFFLE_CLEANUP, "false") == was
    assert after <= before


def test_quality_separates_labels(ready):
    got = {r.doc_id: r.rejected for r in registered.QUERIES["op4_quality"](ready, SF).collect()}
    labels = ready.read.parquet(f"{SF}/labels.parquet").collect()
    bad = [got[r.doc_id] for r in labels if r.quality == 0]
    clean = [got[r.doc_id] for r in labels if r.quality == 1 and r.toxic == 0]
    assert np.mean(bad) >= 0.75 and np.mean(clean) <= 0.02


def test_quality_awkward(awkward, ready):
    trusted = ready.createDataFrame([("en", "some words of a trusted text " * 20), ("en", "others of the same kind " * 20), ("", "x"), ("de", "")],
                                    "lang string, text string")
    got = quality.classify(awkward, trusted).collect()
    assert len(got) == 9
    assert all(r.perplexity is None and r.rejected is False for r in got if not r.text)
    assert all(r.perplexity > 1 for r in got if r.text)
    nothing = quality.classify(awkward, trusted.limit(0)).collect()
    assert len(nothing) == 9 and not any(r.rejected for r in nothing)


@pytest.mark.parametrize("seen", [["one"], ["one", "one", "one"], ["one", "two"]])
def test_clean_documents_of_a_rare_language_stay(ready, seen):
    rng = random.Random(3)
    lexicon = {"en": ["the", "river", "house", "walks", "green", "often", "under", "with", "stone", "bread"],
               "qq": ["zuqa", "qoxi", "wyzk", "jaxu", "vekq", "xozi", "kywa", "quzo", "jixy", "zzak"]}
    prose = lambda lang: " ".join(rng.choice(lexicon[lang]) for _ in range(80))
    named = {n: prose("qq") for n in ("one", "two")}
    trusted = [("en", prose("en")) for _ in range(150)] + [("qq", named[n]) for n in seen]
    junk = "".join(chr(rng.randrange(33, 127)) for _ in range(400))
    docs = [(k, prose("qq"), "qq") for k in range(60)] + [(100 + k, prose("en"), "en") for k in range(60)] + [(200, junk, "en"), (201, junk, "qq")]
    got = quality.classify(ready.createDataFrame(docs, "doc_id long, text string, lang string"),
                           ready.createDataFrame(trusted, "lang string, text string")).collect()
    gone = {r.doc_id for r in got if r.rejected}
    assert {200, 201} <= gone and sum(i < 100 for i in gone) <= 1 and sum(100 <= i < 200 for i in gone) <= 3


# --- nearest neighbours -------------------------------------------------------
def brute_nearest(rows, queries, k):
    out = {}
    for q in queries:
        v = dict(rows)[q]
        scores = [(-np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)), i) for i, w in rows if i != q]
        out[q] = sorted(scores)[:k]
    return out


def test_recall_and_scores(ready):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in ready.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute_nearest(rows, [i for i, _ in rows if i % 50 == 0], 5)
    got = {}
    for r in registered.QUERIES["op5_nearest"](ready, SF).collect():
        got.setdefault(r.query_id, []).append(r)
    vectors = dict(rows)
    for q, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        for r in found:
            a, b = vectors[q], vectors[r.vec_id]
            assert r.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-14)
    met = sum(len({i for _, i in want[q]} & {r.vec_id for r in got[q]}) for q in want)
    assert met >= 0.9 * 5 * len(want)


def test_equal_vectors_and_blocks(ready, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_CANDIDATES", 3)
    monkeypatch.setattr(nearest, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 5)).astype("float32").astype(float)
    rows = [(i, base[i % 6].tolist()) for i in range(40)] + [(100 + i, rng.normal(size=5).astype("float32").astype(float).tolist()) for i in range(20)]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest.nearest_neighbours(df, lambda i: i % 10 == 0, tables=2, probes=16).collect()  # all axes: exact
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
    rows32 = [(i, np.array(v)) for i, v in rows]
    for q, near in brute_nearest(rows32, [i for i, _ in rows if i % 10 == 0], 5).items():
        assert np.allclose([s for s, _ in near], [-r.score for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])])
        if q < 40:  # its copies come first, the smallest ids of them
            assert found[q] == [i for i in range(40) if i % 6 == q % 6 and i != q][:5]


@pytest.mark.parametrize("dim", [64, 128, 384, 768])
def test_recall_at_any_length(ready, dim):
    """Near-random vectors, which hashing hardly tells apart, and few vectors: all candidates if there are fewer than k."""
    rng = np.random.default_rng(dim)
    many = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, dim)).astype("float32").astype(float))]
    got = {}
    for r in nearest.nearest_neighbours(ready.createDataFrame(many, "vec_id long, embedding array<float>").repartition(4), lambda i: i % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute_nearest([(i, np.array(v)) for i, v in many], [i for i, _ in many if i % 50 == 0], 5)
    assert sum(len(got[q] & {i for _, i in near}) for q, near in want.items()) >= 0.9 * 5 * len(want)
    few = ready.createDataFrame(many[:4], "vec_id long, embedding array<float>")
    found = nearest.nearest_neighbours(few, lambda i: i % 2 == 0).collect()
    assert sorted((r.query_id, r.vec_id) for r in found) == [(0, 1), (0, 2), (0, 3), (2, 0), (2, 1), (2, 3)]


def test_hadamard_is_orthonormal():
    h = nearest.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16))


# --- SimHash ------------------------------------------------------------------
def slow_fingerprint(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(line_dedup.UPPER, line_dedup.LOWER)))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_and_classes_against_brute_force(ready):
    docs = ready.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: slow_fingerprint(r.text, 3) for r in docs}
    ids = sorted(prints)
    classes = brute_components([prints[i] for i in ids], 3)
    least = {}
    for i, c in zip(ids, classes):
        least[c] = min(i, least.get(c, i))
    got = registered.QUERIES["op6_simhash"](ready, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (i, f"{prints[i]:016x}", least[c]) for i, c in zip(ids, classes)}


@pytest.mark.parametrize("bits", [1, 3, 5])
def test_no_link_is_lost(ready, bits):
    rng = random.Random(bits)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    prints = []
    for s in seeds:
        for _ in range(rng.randint(1, 12)):
            s ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits + 1)))  # a chain
            prints.append(s)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {r.fp: r.root for r in simhash.linked_classes(ready.createDataFrame([(p,) for p in signed + signed[:5]], "fp long"), bits).collect()}
    want = brute_components(prints, bits)
    sizes = Counter(want)
    assert set(got) == {s for s, c in zip(signed, want) if sizes[c] > 1}
    for a in range(len(prints)):
        for b in range(a):
            if sizes[want[a]] > 1 and sizes[want[b]] > 1:
                assert (got[signed[a]] == got[signed[b]]) == (want[a] == want[b])


def test_spanning_edges_of_many_members():
    rng = np.random.default_rng(1)
    center = np.uint64(0x123456789ABCDEF0)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(3000)], np.uint64)
    members = np.unique(center ^ flips)
    a, b = simhash.spanning_edges(np.append(members, center), 3)
    assert len(a) == len(members)  # one class: a tree


def test_any_seed_links(ready):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(3000)]
    rows = []
    for i in range(60):
        base = rng.choices(words, k=rng.randint(60, 200))
        rows.append((2 * i, " ".join(base)))
        for _ in range(rng.randint(0, 2)):
            base[rng.randrange(len(base))] = "changed"
        rows.append((2 * i + 1, " ".join(base)))
    seeds = (42, 43, 44)
    prints = {i: simhash.fingerprints(t.encode(), 3, seeds) for i, t in rows}
    linked = lambda a, b: any(((x ^ y) & (2 ** 64 - 1)).bit_count() <= 3 for x, y in zip(prints[a], prints[b]))
    want = {a: min([b for b in prints if linked(a, b)]) for a in prints}
    got = {r.doc_id: r.component_id for r in simhash.near_duplicate_classes(ready.createDataFrame(rows, "doc_id long, text string"), seeds=seeds).collect()}
    assert got == want and len(set(got.values())) < 60 + sum(p[0] != q[0] for p, q in ((prints[2 * i], prints[2 * i + 1]) for i in range(60)))


def test_near_duplicates_keep_one(awkward):
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 2, 3, 7, 8] and len(rows) == 6


def test_components_of_a_chain(ready):
    n = 200
    edges = [(i, i + 1) for i in range(0, n)] + [(1000, 1001), (1001, 1000), (5, 5)]
    random.Random(4).shuffle(edges)
    got = {r.node: r.root for r in components.connected_components(ready.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


# --- BPE ----------------------------------------------------------------------
@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.public_tokenizer("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def encoder():
    with open(bpe.public_tokenizer("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    made = bpe.PrefixEncoder(definition)
    made.prepare()
    splitter = bpe.Pretokenizer(definition, made.specials)
    return lambda text: made.encode(text, splitter)


def test_ids_equal_the_library(encoder, tokenizer):
    rng = random.Random(7)
    words = [w.replace("</w>", "") for w in tokenizer.get_vocab()]
    texts = ["".join(rng.choices("aabethinrs'll0 .!ÉéßÑçσΣ", k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choices(words, k=4)) for _ in range(3000)]
    texts += ["a<|endoftext|>b <|startoftext|><|endoftext|>", "<|endoftext", "\x1c\x1d a\x85b\xa0c　d", "漢字 é İ ΑΣ ﬁ"]
    texts += ["".join(f"a{chr(c)}B{chr(c)}{chr(c)} " for c in range(at, at + 32)) for at in range(0, 0x600, 32)]
    for text in texts:
        assert encoder(text) == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_tokens_of_documents(ready, tokenizer):
    got = {r.doc_id: r for r in registered.QUERIES["op7_bpe"](ready, SF).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in ready.read.parquet(f"{SF}/documents.parquet").limit(200).collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        mine = got[r.doc_id]
        assert (mine.n_tokens, mine.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert mine.decoded_sha256 == sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_tokens_awkward(awkward, tokenizer):
    got = bpe.with_tokens(awkward, bpe.public_tokenizer("word_bpe_49k.json"), ids="shard", decoded="n_lines").collect()
    assert len(got) == 9
    for r in got:
        assert r.shard == tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_lines == tokenizer.decode(r.shard, skip_special_tokens=False)


# --- decontamination ----------------------------------------------------------
def brute_hits(words, items, window):
    windows = {}
    for name, ws in items:
        k = min(window, len(ws))
        for i in range(len(ws) - k + 1) if k else ():
            windows.setdefault(tuple(ws[i:i + k]), set()).add(name)
    marks, met = bytearray(len(words)), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if names := windows.get(tuple(words[i:i + size])):
                met |= names
                marks[i:i + size] = b"\1" * size
    return marks, met


def test_automaton_against_brute_force():
    rng = random.Random(3)
    for _ in range(2000):
        window, letters = rng.choice([2, 3, 4]), [b"a", b"b", b"c", b"d"][:rng.choice([2, 3, 4])]
        items = [(str(i), rng.choices(letters, k=rng.randint(0, 8))) for i in range(rng.randint(0, 6))]
        automaton = decontaminate.ItemAutomaton(items, window)
        words = rng.choices([*letters, b"z"], k=rng.randint(0, 20))
        marks, met = automaton.hits(words)
        assert (marks, {items[k][0] for k in met}) == brute_hits(words, items, window)


@pytest.mark.parametrize("shard_words", [100_000, 40])
def test_contamination(ready, awkward, shard_words):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices("abcdefgh", k=20))) for i in range(10)] + [(10, "rare pair"), (11, None), (None, "nameless words here")]
    texts = [None, "", "x y Rare  PAIR! z", items[0][1], "- " + items[1][1].upper().replace(" ", ", ") + " q", "nameless words here"]
    docs = awkward.sparkSession.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, n_hit string")
    got = decontaminate.contamination(docs, ready.createDataFrame(items, "item_id long, text string"), shard_words=shard_words, cut_longer_than=3).orderBy("doc_id").collect()
    known = [("" if i is None else str(i), decontaminate.words_of((t or "").encode())) for i, t in items]
    for r in got:
        words = decontaminate.words_of((r.text or "").encode())
        marks, met = brute_hits(words, known, 13)
        assert (r.n_words, r.n_hit, r.items_met) == (len(words), sum(marks), sorted(met))
        assert r.contaminated == (sum(marks) > 0 and 20 * sum(marks) >= len(words))
    assert got[0].clean_text is None and got[2].clean_text == texts[2] and got[3].clean_text == "" and got[4].clean_text == "-  q"


def test_contamination_awkward(awkward, ready):
    none = ready.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(awkward, none).collect()
    assert len(got) == 9 and not any(r.n_hit or r.contaminated for r in got)


# --- sharding -----------------------------------------------------------------
def test_shards_are_exact(ready):
    got = registered.QUERIES["op9_sharding"](ready, SF).collect()
    docs = ready.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs)
    text = {r.doc_id: (r.text or "").encode() for r in docs}
    assert all(r["size"] == len(text[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id]) for r in got)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))


def test_sharding_query_shuffles_texts(ready, monkeypatch):
    given, real = [], sharding.shuffle_into_shards
    monkeypatch.setattr(sharding, "shuffle_into_shards", lambda rows, *a, **b: given.append(real(rows, *a, **b)) or given[0])
    got = {r.doc_id: r for r in registered.QUERIES["op9_sharding"](ready, SF).collect()}
    texts = {r.doc_id: r.text for r in ready.read.parquet(f"{SF}/documents.parquet").collect()}
    sharded = given[0].collect()
    assert {r.doc_id: r.text for r in sharded} == texts
    assert all((got[r.doc_id].shard, got[r.doc_id].slot) == (r.shard, r.slot) for r in sharded)
    assert all(got[i].text_crc32 == zlib.crc32((t or "").encode()) and got[i].size == len((t or "").encode()) + 8 for i, t in texts.items())


@pytest.mark.parametrize("bins", [2_000_000, 3])
def test_shuffle_awkward(awkward, bins):
    got = sharding.shuffle_into_shards(awkward, 4, rows_per_bin=bins).collect()
    assert sorted(Counter(r.shard for r in got).values()) == [2, 2, 2, 3]
    assert sorted((r.shard, r.slot) for r in got) == sorted((s, k) for s, n in Counter(r.shard for r in got).items() for k in range(n))
    assert Counter(repr(r.text) for r in got) == Counter(repr(r.text) for r in awkward.collect())


def test_shuffle_is_uniform_and_repeatable(ready):
    rows = ready.range(0, 60, 1, 3)
    where = np.zeros((60, 4))
    for seed in range(12):
        got = sharding.shuffle_into_shards(rows, 4, seed=seed).collect()
        assert max(Counter(r.shard for r in got).values()) == 15
        for r in got:
            where[r.id, r.shard] += 1
    assert ((where - 3) ** 2 / 3).sum() < 60 * 3 + 5 * np.sqrt(2 * 60 * 3)
    again = [tuple(r) for r in sharding.shuffle_into_shards(rows, 4, seed=1).orderBy("id").collect()]
    assert again == [tuple(r) for r in sharding.shuffle_into_shards(rows, 4, seed=1).orderBy("id").collect()]


def test_matrix_and_its_law():
    rng = random.Random(1)
    for _ in range(50):
        blocks = [rng.randint(0, 30) for _ in range(rng.randint(1, 8))]
        total = sum(blocks)
        caps = [total // 5 + (s < total % 5) for s in range(5)]
        m = sharding.communication_matrix(blocks, caps, rng.random())
        assert [sum(r) for r in m] == blocks and [sum(c) for c in zip(*m)] == caps
    draws = [sharding.hypergeometric(rng, 30, 100, 20) for _ in range(20_000)]
    assert np.mean(draws) == pytest.approx(6, abs=0.06)
    assert np.var(draws) == pytest.approx(20 * 0.3 * 0.7 * 80 / 99, rel=0.05)
    big = [sharding.hypergeometric(rng, 10**10, 24 * 10**10, 10**6) for _ in range(200)]
    assert np.mean(big) == pytest.approx(10**6 / 24, rel=0.002)


# --- HTML ---------------------------------------------------------------------
def test_pages_give_their_articles(ready):
    pages = {r.page_id: r.html for r in ready.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in registered.QUERIES["op10_html"](ready, SF).collect():
        article = re.search(r"(?s)<article>(.*?)</article>", pages[r.page_id])[1]
        blocks = [html.unescape(re.sub(r"<[^>]+>", "", b)) for b in re.split(r"</?(?:p|h1|ul|li)>", article.replace("<br>", " "))]
        want = "\n".join(x for b in blocks if (x := re.sub(r"\s+", " ", b).strip()))
        assert r.text == want and r.n_chars == len(want)


@pytest.mark.parametrize("page,text", [
    ("", ""),
    ("plain &amp; text", "plain & text"),
    ("<!-- never ends", ""),
    ("<![odd", ""),
    ("<p>a <b>bold</b>\n word<p>c<br>d", "a bold word\nc d"),
    ("<nav>m</nav><header>h</header><article><h1>T</h1><p>x</p><div class='share-bar'>s</div><aside>n</aside></article><footer>f</footer>", "T\nx"),
    ("<main><p>x</p><section id='comments'><article><p>no</p></article></section><form>f</form></main>", "x"),
    ("<div class='cookie-notice'>c</div><p>Some text that is the article of the page.</p><script>var a = '<p>';</script><style>p{}</style>",
     "Some text that is the article of the page."),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one\ntwo\na b"),
    ("<h1>Head</h1><p>" + "long text " * 30 + "</p><p>short</p><p>" + "more text " * 30 + "</p><ul><li><a href='x'>link</a></ul>",
     "Head\n" + ("long text " * 30).strip() + "\nshort\n" + ("more text " * 30).strip()),
    ("<article>&eacute;&#233;&nbsp;x</article>", "éé x"),
    ("<article><p>x</p><div class='topNav'>n</div><div id='commentList'>c</div><p>y</p></article>", "x\ny"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_html_awkward(ready):
    pages = ready.createDataFrame([(1, None, "t"), (2, "", "t"), (2, "", "t"), (3, "<p>" * 20_000 + "deep", "t"), (4, "x" * 300_000, "t")],
                                  "page_id long, html string, text string")
    got = html_text.with_main_text(pages).collect()
    assert sorted((r.page_id, len(r.text)) for r in got) == [(1, 0), (2, 0), (2, 0), (3, 4), (4, 300_000)]


# --- BPE: words of any length, what is remembered --------------------------------
def test_one_huge_word(encoder, tokenizer):
    rng = random.Random(3)
    for word in ("ab" * 30_000, "".join(rng.choices("aetoinshr", k=20_000)), "x" * 65, "é" * 33, "9" * 70, "a" * 64, "ß" + "-" * 500):
        assert encoder(f"to {word}, be") == tokenizer.encode(f"to {word}, be", add_special_tokens=False).ids


def test_stretches_are_forgotten_and_found_again(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 40_000)
    monkeypatch.setattr(bpe, "REMEMBERED_PAIRS", 50)
    monkeypatch.setattr(bpe, "BLOCK", 7)
    with open(bpe.public_tokenizer("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    made = bpe.PrefixEncoder(definition)
    made.prepare()
    splitter, rng = bpe.Pretokenizer(definition, made.specials), random.Random(11)
    for _ in range(60):
        text = " ".join("".join(rng.choices("aeioutnsr.,<|>", k=rng.randint(1, 9))) for _ in range(60)) + " the of and <|endoftext|>"
        assert made.encode(text, splitter) == tokenizer.encode(text, add_special_tokens=False).ids
        assert made.remembered.bytes <= 40_000
        for key, code in list(made.remembered.items())[:50]:
            ids = made.remembered.ids(np.array([code]))[0].tolist()
            assert made.remembered.decoded[code] == " ".join(made.words[i] for i in ids)


# --- HTML: names that name no part, wrappers, teasers, page shapes ----------------
PARAGRAPH = "<p>" + "word " * 60 + "</p>"


@pytest.mark.parametrize("page", [
    f'<body><div class="content has-sidebar">{PARAGRAPH * 5}</div></body>',
    f'<body><div class="content has-sidebar"><h1>T</h1>{PARAGRAPH * 4}</div><div class="sidebar">{PARAGRAPH}</div></body>',
    f'<article><div class="post no-comments">{PARAGRAPH * 5}</div></article>',
    f'<body><div class="post share-enabled">{PARAGRAPH * 5}</div></body>',
    f'<article>{PARAGRAPH * 2}<h2 id="related-work">word</h2>{PARAGRAPH * 2}</article>',
    f'<body><div class="sidebar-layout"><main>{PARAGRAPH * 5}</main><div class="sidebar">{PARAGRAPH}</div></div></body>',
    f'<body><div class="story">{PARAGRAPH * 5}</div><article class="card"><p>{"teaser " * 12}</p></article></body>'])
def test_article_is_kept_whatever_the_names(page):
    lines = html_text.main_text(page).split("\n")
    assert len(lines) == 5 and all(set(line.split()) <= {"word", "T"} for line in lines)


@pytest.mark.parametrize("name", ["sidebar", "comments", "topNav", "related-posts", "ad", "cookie_notice", "site-footer", "share", "Comments2"])
def test_parts_by_name_go(name):
    page = f'<body><div class="x {name}">{PARAGRAPH * 9}</div><div>{PARAGRAPH * 2}</div></body>'
    assert len(html_text.main_text(page).split("\n")) == 2


def test_one_huge_block_does_not_outweigh_the_others():
    some = "".join(f"<p>{'abcd ' * 60}</p>" for _ in range(20))
    page = f"<body>{some}<p>{'abcd ' * 9200}</p>{some}</body>"
    assert len(html_text.main_text(page).split("\n")) == 41


def test_unmatched_and_deep_tags_are_linear():
    import time
    began = time.time()
    html_text.main_text("<b>" * 30_000 + "</i>" * 30_000 + "<p>x" * 5000)
    html_text.main_text('<div class="menu">' * 30_000 + "x" + "</div>" * 30_000)
    assert time.time() - began < 10          # quadratic: minutes


def slow_smoothed(values):
    """The Gaussian mean written out."""
    out = []
    for i in range(len(values)):
        pairs = [(math.exp(-(i - j) ** 2 / 2), v) for j, v in enumerate(values) if abs(i - j) <= 2]
        out.append(sum(w * v for w, v in pairs) / sum(w for w, _ in pairs))
    return out


def slow_text(page):
    """Pages without tables, hidden parts or broken tags, by a tree: lines with their ratios, then the rules in plain words."""
    tags, root = re.findall(r"<(/?)(\w+)([^>]*)>|([^<]+)", page), {"tag": "", "kids": [], "names": ""}
    stack = [root]
    for end, tag, attrs, text in tags:
        if text:
            stack[-1]["kids"].append(text)
        elif end:
            stack.pop()
        else:
            node = {"tag": tag, "kids": [], "names": " ".join(re.findall(r'(?:class|id)="([^"]*)"', attrs))}
            stack[-1]["kids"].append(node)
            stack.append(node)
    lines, now = [], {"text": "", "tags": 0}

    def flush():
        text = " ".join(now["text"].split())
        if text:
            lines.append((text, len(text) / max(1, now["tags"])))
        now.update(text="", tags=0)

    def walk(node, out):
        block = node["tag"] in html_text.BLOCKS
        if block:
            flush()
        now["tags"] += bool(node["tag"])
        out = out or node["tag"] in html_text.OUTSIDE or (node["tag"] != "body" and html_text.names_part(node["names"]))
        for kid in node["kids"]:
            if isinstance(kid, str):
                now["text"] += "" if out else kid
            else:
                walk(kid, out)
        now["tags"] += bool(node["tag"])
        if block:
            flush()
    walk(root, False)
    if not lines:
        return ""
    ratios = slow_smoothed([r for _, r in lines])
    mean = sum(ratios) / len(ratios)
    least = min(40, 0.5 * math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios)))
    found = [i for i, r in enumerate(ratios) if r >= least]
    return "\n".join(t for t, _ in lines[found[0]:found[-1] + 1]) if found else ""


@pytest.mark.parametrize("seed", range(25))
def test_pages_against_brute_force(seed):
    rng = random.Random(seed)

    def block(depth):
        if depth == 0 or rng.random() < 0.5:
            words = " ".join(rng.choice(["alpha", "be", "gamma", "d"]) for _ in range(rng.choice([1, 3, 8, 40, 120])))
            return f"<p>{words}</p>" if rng.random() < 0.7 else f"<div>{words} <b>x</b> <i>y</i></div>"
        name = rng.choice(["", ' class="story"', ' class="sidebar"', ' class="has-menu"', ' id="comments"'])
        tag = rng.choice(["div", "section", "ul", "nav"])
        return f"<{tag}{name}>" + "".join(block(depth - 1) for _ in range(rng.randint(1, 5))) + f"</{tag}>"
    page = "<body>" + "".join(block(3) for _ in range(6)) + "</body>"
    assert html_text.main_text(page) == slow_text(page)


# --- language: whole texts, many labels, predictions recomputed --------------------
def test_dictionaries_come_from_whole_texts(ready):
    filler = "common words at the start " * 400
    rows = [("a", f"{filler} zebrafish quagga {k}") for k in range(20)] + [("b", None), (None, "x"), ("c", "1234"), ("d", "only once")]
    learned = dict(language.learn_dictionaries(ready.createDataFrame(rows, "lang string, text string")))
    assert set(learned) == {"a", "d"} and b"zebrafish quagga" in learned["a"] and learned["d"] == b" only once only once "


def test_very_many_labels_share_the_memory(ready, monkeypatch):
    monkeypatch.setattr(language, "MAX_DICTIONARIES", 30_000)
    rows = [(f"l{k}", f"word{k} " * 3 + "some other words that stand in every text " * 5) for k in range(300)]
    learned = language.learn_dictionaries(ready.createDataFrame(rows, "lang string, text string"))
    assert len(learned) == 300 and sum(len(d) for _, d in learned) <= 30_000 + 300 and all(d.strip() for _, d in learned)


def test_predictions_against_plain_compression(ready):
    import zstandard
    docs = ready.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    learned = language.learn_dictionaries(docs)
    got = {r.doc_id: r for r in language.with_language(docs.select("doc_id", "text"), learned).collect()}
    params = zstandard.ZstdCompressionParameters.from_level(language.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    coders = [(lang, zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                              compression_params=params)) for lang, d in learned]
    for r in docs.collect():
        words = re.findall(r"[^\W\d_]+", (r.text or "").lower())
        text = f" {' '.join(words)} ".encode()
        size = {lang: sum(len(c.compress(text[i:i + language.BLOCK_BYTES])) for i in range(0, len(text), language.BLOCK_BYTES)) for lang, c in coders}
        first, second = sorted(size.values())[:2]
        assert size[got[r.doc_id].lang_pred] == first and got[r.doc_id].score == pytest.approx(1 - first / second)


# --- WARC: records of other writers -----------------------------------------------
def standard_record(kind, fields, block):
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), ("WARC-Record-ID", "<urn:uuid:b92e8444-34cf-472f-a86e-07b7845ecc05>"),
                                                ("WARC-Date", "2024-05-01T10:00:00Z"), *fields, ("Content-Length", len(block))])
    return f"WARC/1.0\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def test_a_standard_archive():
    body = "<p>é</p>".encode()
    http = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\nX-Long: one\r\n two\r\nContent-Type: text/html\r\n\r\n" + body
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\n" + body[:4] + b"\r\n" + b"%x\r\n" % len(body[4:]) + body[4:] + b"\r\n0\r\n\r\n"
    uri = ("WARC-Target-URI", "http://example.org/")
    records = [
        standard_record("warcinfo", [("Content-Type", "application/warc-fields")], b"software: x\r\n"),
        standard_record("request", [uri, ("Content-Type", "application/http; msgtype=request"), ("WARC-Concurrent-To", "<urn:uuid:1>"),
                                    ("WARC-Concurrent-To", "<urn:uuid:2>")], b"GET / HTTP/1.1\r\nHost: example.org\r\n\r\n"),
        standard_record("response", [uri, ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{warc.digest(body)}")], http),
        standard_record("response", [uri, ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{warc.digest(body)}")], chunked),
        standard_record("response", [uri, ("WARC-Payload-Digest", "sha256:abc")], b"HTTP/1.0 204 No Content\r\n\r\n"),
        standard_record("revisit", [uri, ("WARC-Refers-To-Target-URI", "http://example.org/"), ("Content-Type", "application/http")], b"HTTP/1.1 304 Not Modified\r\nETag: 1\r\n\r\n"),
        standard_record("metadata", [("Content-Type", "application/warc-fields")], b"fetchTimeMs: 3\r\n"),
        standard_record("resource", [uri, ("Content-Type", "image/png")], b"\x89PNG")]
    found = list(warc.read_archive(_archive(records)))
    assert [r["record_type"] for r in found] == ["warcinfo", "request", "response", "response", "response", "revisit", "metadata", "resource"]
    assert all(r["page_id"] is None and r["refers_to"] is None and r["record_id"].startswith("<urn:uuid:") for r in found)
    assert found[2]["payload"] == body and found[2]["payload_bytes"] == len(body) and found[4]["payload"] == b""
    assert found[3]["payload"].startswith(b"4\r\n") and found[5]["payload"] is None and found[7]["payload"] == b"\x89PNG"


@pytest.mark.parametrize("bad", [
    standard_record("response", [("WARC-Payload-Digest", "sha1:AAAA")], b"HTTP/1.1 200 OK\r\n\r\nx"),
    standard_record("response", [], b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nx"),
    standard_record("response", [], b"HTTP/1.1 200 OK\r\nContent-Length: five\r\n\r\nx"),
    standard_record("response", [], b"not http"),
    standard_record("revisit", [("Content-Type", "application/http")], b"HTTP/1.1 304 Not Modified\r\n\r\n"),
    standard_record("metadata", [("WARC-Block-Digest", "sha1:AAAA")], b"x"),
    standard_record("metadata", [("no colon", "")], b"x").replace(b"no colon: ", b"no colon ")])
def test_broken_standard_records(bad):
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(_archive([bad])))
