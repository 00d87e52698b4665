"""The trie of conversations against brute force, and the decomposition by itself."""

import random
from hashlib import sha256
from zlib import crc32

import pytest

from folia.llm import catalog, prefixtrie
from folia.llm.prefixtrie import Heads, Rollup

SCHEMA = "conv_id long, turn long, role string, text string, depth long, p string"


def plain_rebuilt(rows, heads):
    turns = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in turns.items()}
    if heads is None:
        return turns
    drawn = {c: crc32(str(c).encode()) % heads.turns for c in turns}
    return {c: turns.get(c - c % heads.group, [])[: drawn[c]] + ts[drawn[c] :] for c, ts in turns.items()}


def plain_trie(rows, heads):
    rebuilt = plain_rebuilt(rows, heads)
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    expected = []
    for node, own in members.items():
        beneath = [n for n in members if n[: len(node)] == node]
        children = [n for n in beneath if len(n) == len(node) + 1]
        leaves = sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in beneath) for n in beneath)
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in beneath if n)
        ends = ",".join(map(str, sorted(c for c in own if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        numbers = (min(own), len(node), parent, len(own), len(children), leaves, saved)
        expected.append((*numbers, sha256(ends.encode()).hexdigest()))
    return sorted(expected)


def found(spark, rows, heads, rollup=Rollup()):
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, prefixtrie.prefix_trie(frame, heads, rollup).collect()))


def drawn(seed, conversations=60, texts=3, longest=9):
    source = random.Random(seed)
    rows = []
    for i in range(conversations):
        c = source.choice([i, 100 + i, 200 + 3 * i])
        for turn in range(source.randint(1, longest)):
            rows.append((c, turn, source.choice(["user", "bot"]) if turn % 4 == 3 else "user", "é" * source.randint(0, texts)))
    return rows


AWKWARD = [
    (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 5, "user", "b" * 5000),
    (None, 0, "user", "lost"), (None, None, None, None), (7, None, "user", ""), (7, None, None, ""),
    (101, 0, "user", "no base"), (102, 0, "user", "no base"), (205, 3, "user", "a"),
    (9_000_000_000, 0, "u", "a"), (9_000_000_001, 0, "u", "a"), (9_000_000_002, 0, "ua", ""),
]


@pytest.mark.parametrize("weight", [1, 6, 100_000])
def test_trie(spark, weight):
    rows = drawn(weight) + AWKWARD
    for heads in (None, Heads()):
        assert found(spark, rows, heads, Rollup(weight=weight)) == plain_trie(rows, heads)


def test_long_and_copied_conversations(spark, monkeypatch):
    """Blocks of turns, a deep path, and many copies whose ids fill several ranges."""
    monkeypatch.setattr(prefixtrie, "_BLOCK", 4)
    monkeypatch.setattr(prefixtrie, "_CHUNK", 2)
    monkeypatch.setattr(prefixtrie, "_HEAVY", 5)
    deep = [(c, t, "user", str(t)) for c in (1, 3) for t in range(60 + c)]
    copies = [(c, t, "user", "same"[:t]) for c in range(200, 260) for t in range(3)]
    rows = deep + copies + drawn(3, 20)
    for weight in (20, 100_000):
        assert found(spark, rows, None, Rollup(weight=weight)) == plain_trie(rows, None)
    assert found(spark, rows, Heads(), Rollup(weight=30, components=10)) == plain_trie(rows, Heads())


def test_empty(spark):
    assert found(spark, [], Heads()) == []
    assert found(spark, [(None, 1, "a", "b")], None) == []
    assert found(spark, [(1, None, None, None)], None) == plain_trie([(1, None, None, None)], None)


def test_decompose():
    """Random trees, paths and stars; every path a node is on is halved."""
    for seed in range(60):
        source = random.Random(seed)
        size = source.randint(1, 60)
        kind = seed % 3
        parents = [-1 if i == 0 or source.random() < 0.05 else (source.randrange(i), i - 1, 0)[kind] for i in range(size)]
        tops = []
        for i, up in enumerate(parents):
            tops.append(i if up < 0 else tops[up])
        value = [source.randint(-3, 9) for _ in range(size)]
        expected = list(value)
        for i in range(size - 1, -1, -1):
            if parents[i] >= 0:
                expected[parents[i]] += expected[i]
        assert prefixtrie.decompose(parents, tops, [value, [1] * size])[0] == expected
    assert prefixtrie.decompose([], [], [[]]) == [[]]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert sorted(map(tuple, catalog.op13_prefix_trie(spark, sf).collect())) == plain_trie(rows, Heads())
