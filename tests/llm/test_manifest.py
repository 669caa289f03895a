"""The Merkle manifest against a plain recomputation."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from chronogrid.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, _tree int"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k:k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = nodes[i // 16 * 16:i // 16 * 16 + 16]
        out.append((run[:i % 16], run[i % 16 + 1:]))
        i //= 16
    return out


def brute(rows, changed):
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    levels = {s: climb([leaf_of(r) for r in trees[s]]) for s in order}
    top = climb([levels[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(trees[s]):
            path = siblings(levels[s], i) + siblings(top, k)
            at = leaf_of(changed(r))
            for left, right in path:
                at = H(*left, at, *right)
            out.append((r[0], leaf_of(r), levels[s][-1][0], top[-1][0], H(*[x for p in path for x in p[0] + p[1]]), at, at == top[-1][0]))
    return sorted(out, key=repr)


def tampered(r):
    if r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 or r[4] is None:
        return r
    return (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]), *r[5:])


@pytest.mark.parametrize("height", [1, 2, manifest.LEVELS])
def test_against_brute_force(ready, height):
    rows = [(i, f"s{i % 19}", "en", i, f"Text É {i}", "x", 1) for i in range(150)]          # 19 groups: two runs above
    rows += [(1000 + i, "hot", None, None, "Same" if i % 3 else None, "x", 1) for i in range(300)]   # three levels
    rows += [(None, None, None, None, None, None, None)] * 2 + [(7, None, "", 0, "", "", 0), (8, "Ä", "", 0, "A" * 100_000, "", 0)]
    rows += [(1000, "hot", None, None, None, "x", 1), (1000, "hot", None, 5, "Other", "x", 1)]       # repeated rows and ids
    docs = ready.createDataFrame(rows, SCHEMA).repartition(5)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = manifest.merkle_manifest(docs, COLUMNS, changed={"text": F.translate("text", manifest.UPPER, manifest.LOWER)},
                                   changed_where=hit, height=height)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, tampered)


def test_one_row_and_no_change(ready):
    rows = [(1, "a", "en", 1, "T", "x", 1)]
    got = manifest.merkle_manifest(ready.createDataFrame(rows, SCHEMA), COLUMNS).collect()
    leaf = leaf_of(rows[0])
    assert [tuple(r) for r in got] == [(1, leaf, leaf, leaf, H(), leaf, True)]


def test_states_resume():
    parent = manifest.Parent([H(str(k)).encode() for k in range(16)])
    for slot in range(16):
        assert manifest.resume(parent.before[slot], H(str(slot)).encode(), parent.right(slot)) == parent.digest
        assert manifest.resume(parent.before[slot], H("x").encode(), parent.right(slot)) != parent.digest
