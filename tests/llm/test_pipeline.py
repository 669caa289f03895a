"""The corpus pipeline: planted cases, awkward rows, and the stages against their operators."""

import hashlib
import random

import corpus_pipeline as P
from chronogrid.llm import decontaminate, quality, simhash
from chronogrid.session import materialise

from .conftest import AWKWARD
from .test_operators import brute_components, brute_hits, brute_lines, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe_encoding"]


def test_each_stage_against_brute_force(ready):
    docs = ready.read.parquet(f"{SF}/documents.parquet")
    labels = ready.read.parquet(f"{SF}/labels.parquet")
    rows = lambda df: {r.doc_id: r for r in df.collect()}

    first = materialise(P.quality_stage(ready, docs, SF), "t")
    judged = quality.classify(docs, quality.trusted_texts(docs, labels)).collect()
    assert first.columns == docs.columns
    assert set(rows(first)) == {r.doc_id for r in judged if not r.rejected} and len(rows(first)) < docs.count()

    second = materialise(P.line_stage(ready, first, SF), "t")
    assert second.columns == docs.columns and second.schema == docs.schema
    want = {i: t for i, t, _, _ in brute_lines([(r.doc_id, r.text) for r in first.collect()], 40, 5)}
    assert {i: r.text for i, r in rows(second).items()} == want
    assert all(r.n_chars == len(r.text) for r in second.collect())

    third = materialise(P.near_duplicate_stage(ready, second, SF), "t")
    assert third.columns == docs.columns
    kept, given = rows(third), rows(second)
    assert all(kept[i] == given[i] for i in kept)
    ids = sorted(given)
    classes = brute_components([slow_fingerprint(given[i].text, 3) for i in ids], 3)
    assert set(kept) == {ids[k] for k in smallest(classes)}

    fourth = materialise(P.decontamination_stage(ready, third, SF), "t")
    items = [(str(r.item_id), decontaminate.words_of(r.text.encode())) for r in ready.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, r in kept.items():
        words = decontaminate.words_of((r.text or "").encode())
        hit = sum(brute_hits(words, items, 13)[0])
        assert (i in rows(fourth)) == (not (hit > 0 and 20 * hit >= len(words)))

    last = rows(P.token_stage(ready, fourth, SF))
    assert set(last) == set(rows(fourth))
    assert all(len(r.token_ids) == r.n_tokens for r in last.values())
    assert {r.doc_id for r in P.run(ready, SF).collect()} == set(last)


def test_quality_stage_leaves_the_driver_a_small_plan(ready):
    docs = ready.read.parquet(f"{SF}/documents.parquet")
    plan = P.quality_stage(ready, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" in plan and "Join" not in plan and plan.count("Exchange") == 1


def test_awkward_rows(ready, tables):
    schema = "doc_id long, text string, lang string, source string, n_chars long, rejected string, perplexity string, _row int, n_hit int, id int, m1 int"
    rows = [(i, t, lang, None, None if t is None else len(t), "mine", "x", 1, 2, 3, 4) for i, t, lang in AWKWARD]
    sf = tables(documents=(rows, schema), labels=([(1, 1, 0), (8, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int"),
                benchmark=([(1, None), (2, "x y")], "item_id long, text string"))
    docs = ready.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES:
        docs = materialise(stage(ready, docs, sf), "t")
        if name != P.STAGES[-1][0]:
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    assert {1, 7, 8} - {r.doc_id for r in docs.collect()} <= {7, 8}  # those two may be judged unlike the trusted text


def test_empty(ready, tables):
    sf = tables(documents=([], "doc_id long, text string, lang string, source string, n_chars long"),
                labels=([], "doc_id long, quality int, toxic int"), benchmark=([], "item_id long, text string"))
    assert P.run(ready, sf).count() == 0


def test_copies_go_and_one_stays(ready):
    words = [hashlib.md5(str(k).encode()).hexdigest()[:6] for k in range(400)]
    text = " ".join(words)
    other = " ".join(reversed(words))
    rows = [(5, text), (3, text), (9, text + " end"), (4, other), (None, text)]
    docs = ready.createDataFrame(rows, "doc_id long, text string")
    got = P.near_duplicate_stage(ready, docs, SF).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got) == [(False, 3), (False, 4), (True, None)]
    assert simhash.fingerprint(text.encode(), 3) == slow_fingerprint(text, 3)


def smallest(classes):
    """The first member of each class."""
    return {classes.index(c) for c in classes}


def test_near_copies_against_brute_force(ready):
    """Pairs of any similarity and a large family of near copies: exactly one document a class of links stays."""
    rng = random.Random(8)
    texts = []
    for k in range(150):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 200, 800]))]
        copy = list(words)
        for at in rng.sample(range(len(words)), 1 + k % 4):
            copy[at] = f"x{rng.randrange(5000)}"
        texts += [" ".join(words), " ".join(copy)]
    base = [f"w{k}" for k in range(600)]
    for _ in range(250):
        words = list(base)
        for at in rng.sample(range(600), rng.randrange(6)):
            words[at] = f"x{rng.randrange(5000)}"
        texts.append(" ".join(words))
    docs = ready.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id for r in P.near_duplicate_stage(ready, docs, SF).collect()}
    classes = brute_components([slow_fingerprint(t, 3) for t in texts], 3)
    assert left == smallest(classes) and len(left) < len(texts) - 150
