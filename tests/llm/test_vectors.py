"""Flat graph and tree search against comparing all vectors."""

import numpy as np
import pytest

from folia.llm import flatgraph, vectortree

SCHEMA = "vec_id long, embedding array<float>, label int, n_links long, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, None, None) for i, v in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(3)
    rows = random.normal(size=(700, 16))
    rows[500:560] = rows[0] + random.normal(size=(60, 16)) * 0.05
    rows[560:600] = rows[1:41] + random.normal(size=(40, 16)) * 0.08
    rows[600] = rows[601]
    rows = rows.astype(np.float32).tolist()
    odd = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15]
    return [*enumerate(rows), *((1000 + 20 * i, v) for i, v in enumerate(odd)), (3, rows[3])]


def good(vectors):
    kept = [(i, v) for i, v in vectors if v and None not in v and np.isfinite(v).all() and np.any(v)]
    return [i for i, _ in kept], np.array([v for _, v in kept], np.float64)


def brute(vectors, similarity):
    ids, rows = good(vectors)
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    linked = units @ units.T >= similarity
    np.fill_diagonal(linked, False)
    lowest = np.array(ids)
    for _ in range(len(ids)):
        lowest = np.minimum(lowest, np.where(linked, lowest[None, :], 1 << 60).min(axis=1))
    expected = [(i, int(n), int(c)) for i, n, c in zip(ids, linked.sum(axis=1), lowest)]
    return expected + [(i, 0, i) for i, v in vectors if i >= 1000]


@pytest.mark.parametrize("graph", [flatgraph.FlatGraph(), flatgraph.FlatGraph(block=64, degree=8)])
def test_links(spark, vectors, graph):
    found = flatgraph.near_duplicates(frame(spark, vectors), graph).collect()
    rows = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found)
    expected = sorted(brute(vectors, graph.similarity))
    assert all(a[0] == b[0] and a[1] <= b[1] for a, b in zip(rows, expected))
    assert sum(r[1] for r in rows) >= 0.97 * sum(r[1] for r in expected)
    if graph.block > 64:
        assert rows == expected
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert found[0]["audited_recall"] >= 0.97


def test_rare_links_are_not_lost(spark):
    """A few pairs among many vectors that the first draw has none of, in shards apart."""
    random = np.random.default_rng(11)
    rows = random.normal(size=(990, 24))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    for i in range(40):
        step = random.normal(size=24)
        step -= (step @ rows[i]) * rows[i]
        rows[700 + i] = rows[i] + 0.32 * step / np.linalg.norm(step)
    vectors = [*enumerate(rows.astype(np.float32).tolist())]
    graph = flatgraph.FlatGraph(overlap=1, block=30, degree=2, audited=1, steps=1)
    found = flatgraph.near_duplicates(frame(spark, vectors), graph).collect()
    rows = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found)
    assert rows == sorted(brute(vectors, graph.similarity))
    assert sum(r[1] for r in rows) == 80


def test_links_still_missed_when_all_shards_meet(spark, vectors):
    """A graph of degree 1 that is hardly searched: all vectors are compared in the end."""
    graph = flatgraph.FlatGraph(degree=1, steps=1, slack=0.0, block=8000, scanned=100, linked=20, recall=0.99999)
    found = flatgraph.near_duplicates(frame(spark, vectors), graph).collect()
    rows = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found)
    assert rows == sorted(brute(vectors, graph.similarity))


def test_recall_is_the_lowest_of_its_classes():
    truth = {i: 500 for i in range(90)} | {100 + i: 1 for i in range(10)}
    assert flatgraph.audited_recall(truth, {i: 500 for i in range(90)}) == 0.0
    assert flatgraph.audited_recall(truth, truth) == 1.0


def test_no_vectors(spark):
    assert flatgraph.near_duplicates(frame(spark, [])).count() == 0
    only = flatgraph.near_duplicates(frame(spark, [(1, None), (None, [0.0, 0.0])])).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["kept"]) for r in only) == [("1", 0, True), ("None", 0, True)]
    queries = vectortree.F.col("vec_id") % 20 == 0
    assert vectortree.nearest_vectors(frame(spark, []), queries).count() == 0
    few = vectortree.nearest_vectors(frame(spark, [(20, [1.0, 0.0]), (7, [0.5, 1.0]), (5, [0.5, 2.0])]), queries)
    assert [(r["vec_id"], r["rank"], r["score"]) for r in few.orderBy("rank").collect()] == [(5, 1, 0.5), (7, 2, 0.5)]


def test_pruning_keeps_the_nearest_and_no_clusters():
    random = np.random.default_rng(0)
    units = flatgraph.unit_rows(random.normal(size=(120, 8)))
    near = units @ units.T
    linked = flatgraph.pruned_graph(near, 12, 1.2)
    np.fill_diagonal(near, -2)
    assert linked[np.arange(120), near.argmax(axis=1)].all()
    assert (linked == linked.T).all() and not linked.diagonal().any()
    assert linked.sum() < 120 * 24


def test_tree_search(spark, vectors):
    search = vectortree.TreeSearch(k=10, leaf=40, block=100)
    found = vectortree.nearest_vectors(frame(spark, vectors), vectortree.F.col("vec_id") % 20 == 0, search).collect()
    ids, rows = good(vectors)
    at = {i: k for k, i in enumerate(ids)}
    queries = [i for i in ids if i % 20 == 0]
    assert {r["query_id"] for r in found} == set(queries)
    hits = 0
    for query in queries:
        own = sorted((r for r in found if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        scores = rows @ rows[at[query]]
        assert all(abs(scores[at[r["vec_id"]]] - r["score"]) < 1e-12 for r in own)
        assert [(-r["score"], r["vec_id"]) for r in own] == sorted((-r["score"], r["vec_id"]) for r in own)
        best = sorted((-s, i) for s, i in zip(scores, ids) if i != query)[:10]
        hits += len({i for _, i in best} & {r["vec_id"] for r in own})
    assert hits >= 0.9 * 10 * len(queries)


def test_tree_visits_everything_in_the_end():
    rows = np.random.default_rng(1).normal(size=(500, 6))
    tree = vectortree.grow(rows, 4, 20, 0)
    assert sorted(tree.visits(rows[0], tree.leaves)) == list(range(tree.leaves))
    assert set(tree.place(rows)) <= set(range(tree.leaves))
    assert vectortree.grow(np.ones((50, 3)), 4, 10, 0).leaves == 1
