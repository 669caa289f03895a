"""The conversation trie against a plain one."""

import hashlib
import random
import zlib

import pytest

from chronogrid.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, n_convs string, keys int"


def rebuilt(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c / 100) * 100 if c < 0 else c - c % 100
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def brute(convs):
    nodes = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = sum(saved[k] for k in kids.get(p, [])) + ((len(nodes[p]) - 1) * len(p[-1][1]) if p else 0)
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        for turn in range(rng.choice([1, 2, 3, 3, 4, 5, 8])):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(["a", "a", "a", "bé", "ccc 🙂"]), "x", 1))
    return rows


AWKWARD = ([(900, k, "user", "same", "x", 1) for k in range(7)] + [(901 + c, k, "user", "same", "x", 1) for c in range(60) for k in range(7)]
           + [(None, 1, "user", "none", "x", 1), (5000, None, None, None, None, None), (5000, None, "user", "", None, None),
              (5001, 3, "a", "b", "x", 1), (5001, 3, "a", "b", "x", 1), (5001, 3, "", "ab", "x", 1), (-150, 0, "user", "below zero", "x", 1),
              (-100, 0, "user", "base", "x", 1), (7777, 0, "user", "long " * 100_000, "x", 1)]
           + [(8000 + c, k, "user", f"deep {k}", "x", 1) for c in range(3) for k in range(300 + c)])


@pytest.mark.parametrize("rows", [random_rows(1, 400), AWKWARD, random_rows(2, 60) + AWKWARD, AWKWARD[:7]], ids=["random", "awkward", "both", "one"])
@pytest.mark.parametrize("partitions", [1, 30])
def test_against_brute_force(ready, rows, partitions):
    before = ready.conf.get("spark.sql.shuffle.partitions"), ready.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    ready.conf.set("spark.sql.shuffle.partitions", partitions)
    ready.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = ready.createDataFrame(rows, SCHEMA)
        got = trie.prefix_trie(trie.with_shared_heads(trie.sequences(turns))).collect()
    finally:
        ready.conf.set("spark.sql.shuffle.partitions", before[0])
        ready.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert sorted((tuple(r) for r in got), key=repr) == brute(rebuilt(rows))


@pytest.mark.parametrize("seed", range(12))
def test_contracted_forests_merge(seed):
    """Any cut into blocks, merged in any grouping, closes every node once with the same figures."""
    rng = random.Random(seed)
    convs = rebuilt(random_rows(seed, 80))
    key = lambda t: hashlib.sha256(repr(t).encode()).digest()[:trie.KEY]
    rows = sorted((b"".join(map(key, ts)), c, [len(t[1]) for t in ts]) for c, ts in convs.items())
    sink, forests = trie.Sink(), []
    while rows:
        n = rng.randint(1, 25)
        forests.append(trie.contract([trie.Path(k, s, {len(s): trie.Part(1, c)}) for k, c, s in rows[:n]], sink, [c for _, c, _ in rows[:n]]))
        rows = rows[n:]
    while len(forests) > 1:
        k = rng.randrange(len(forests) - 1)
        forests[k:k + 2] = [trie.contract(forests[k] + forests[k + 1], sink)]
    trie.contract(forests[0], sink, whole=True)
    want = [x[:2] + x[3:7] for x in brute(convs)]
    got = [tuple(r[c] for c in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved")) for r in sink.rows if r["kind"] == "node"]
    assert sorted(got) == sorted(want)
    named = {r["node_id"]: r["conv_id"] for r in sink.rows if r.get("node_id") and r["kind"] == "node"}
    parents = {(r["conv_id"], r["depth"]): r.get("parent_conv_id") if r.get("parent_conv_id") is not None else named.get(r.get("parent_id"))
               for r in sink.rows if r["kind"] == "node"}
    assert parents == {x[:2]: x[2] for x in brute(convs)}


def test_no_conversations(ready):
    empty = ready.createDataFrame([(None, 1, "a", "b", "x", 1)], SCHEMA)
    assert trie.prefix_trie(trie.with_shared_heads(trie.sequences(empty))).count() == 0


def test_partition_of_several_blocks(ready):
    """More conversations in one partition than a block holds: what its blocks' merges close is complete, too."""
    rng = random.Random(3)
    rows = [(c, turn, "user", f"{c % 3} {rng.randrange(1 + 40 * turn)}", "x", 1) for c in range(2 * trie.BLOCK_ROWS + 500) for turn in range(2 + c % 3)]
    before = ready.conf.get("spark.sql.shuffle.partitions")
    ready.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        got = trie.prefix_trie(trie.with_shared_heads(trie.sequences(ready.createDataFrame(rows, SCHEMA)))).collect()
    finally:
        ready.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((tuple(r) for r in got), key=repr) == brute(rebuilt(rows))
