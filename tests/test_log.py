"""The search over compressed codes, and the vector table that several writers append to."""

import dataclasses
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from folia.config import Settings
from folia.operators import ann, pivots, quantised, search
from folia.operators.pivots import Pivots
from folia.operators.quantised import Depth, Quantising
from folia.session import scratch_path
from folia.sources import commits, vectors
from folia.sources.commits import CommitLog
from folia.sources.vectorlog import VectorLog

SETTINGS = Settings(embedding_dimensions=16)
SMALL = Quantising(per_list=40, parts=8, queries=60, top_k=5)


def clustered(spark, first, number, centre, seed=1):
    random = np.random.default_rng(seed)
    rows = np.asarray(centre) + random.normal(0, 0.4, (number, 16))
    return [(first + i, [float(x) for x in r]) for i, r in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, embedding array<float>").repartition(4)


def recall(spark, path, table, every=7, **more):
    queries = table.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "embedding")
    found = quantised.quantised_search_many(spark, path, queries, 5, **more)
    return ann.recall(found, search.search_many(table, queries, 5)).first()["recall"]


@pytest.fixture(scope="module")
def table(spark):
    random = np.random.default_rng(3)
    rows = [r for k in range(12) for r in clustered(spark, 100 * k, 100, random.normal(0, 1, 16), k)]
    rows += [(2000, [0.0] * 16), (2001, None), (2002, rows[0][1])]
    return frame(spark, rows)


def test_codes(spark, table):
    """Calibrated recall, fewer rows read, exact similarities, and the rule for ties."""
    path = scratch_path(spark, "codes")
    quantised.build_quantised_index(table, path, SMALL)
    depth, codes = quantised.load_depth(spark, path), quantised.load_codes(spark, path)
    assert len(codes.centres) == 30 and depth.recall >= SMALL.recall and depth.compared < 400
    assert recall(spark, path, table) >= 0.9
    asked = table.where("id IN (0, 505, 2000, 2001)").select(F.col("id").alias("query_id"), "embedding")
    found = quantised.quantised_search_many(spark, path, asked, 3).orderBy("query_id", "rank").collect()
    assert {r["query_id"] for r in found} == {0, 505}
    assert [r["id"] for r in found if r["query_id"] == 0][:2] == [0, 2002]
    exact = {(r["query_id"], r["id"]): r["similarity"] for r in search.search_many(table, asked.where("query_id = 0"), 1203).collect()}
    assert all(exact[0, r["id"]] == pytest.approx(r["similarity"], abs=1e-9) for r in found if r["query_id"] == 0)
    # All rows, also from lists that were not to be read.
    assert quantised.quantised_search_many(spark, path, asked, 1500, Depth(1, 5, 5, 0.0)).count() == 2 * 1201
    every = Depth(30, 1500, 5, 1.0)
    assert recall(spark, path, table, depth=every) == 1.0
    hits = quantised.quantised_search(table, path, table.where("id = 7").first()["embedding"], 4, columns=["id"])
    assert hits.first()["id"] == 7 and hits.count() == 4


def test_codes_of_appended_vectors(spark, table):
    path = scratch_path(spark, "codes")
    quantised.build_quantised_index(table, path, SMALL)
    more = frame(spark, clustered(spark, 5000, 300, [2.0] * 16, 99))
    quantised.add_to_quantised_index(more, path)
    # The codebooks know nothing of the new cluster, so more vectors are compared.
    both, query = table.union(more), more.where("id = 5004").first()["embedding"]
    hits = quantised.quantised_search(both, path, query, 3, Depth(10, 350, 3, 1.0), ["id"])
    assert hits.first()["id"] == 5004
    assert quantised.is_quantised(spark, path) and not quantised.is_quantised(spark, path + "x")


def test_few_and_no_vectors(spark):
    path = scratch_path(spark, "codes")
    quantised.build_quantised_index(frame(spark, [(1, [1.0, 0.0, 2.0])]), path)
    asked = spark.createDataFrame([("a", [1.0, 1.0, 1.0]), ("b", [0.0] * 3)], "query_id string, embedding array<float>")
    rows = quantised.quantised_search_many(spark, path, asked).collect()
    assert [(r["query_id"], r["rank"], r["id"]) for r in rows] == [("a", 1, 1)]
    with pytest.raises(ValueError):
        quantised.build_quantised_index(frame(spark, [(1, [0.0, 0.0])]), scratch_path(spark, "codes"))


def chunks(spark, name, number):
    rows = [(name, f"{name}.pdf", i, f"{name} text {i}", None) for i in range(number)]
    return spark.createDataFrame(rows, "source string, filename string, chunk_index int, content string, metadata string")


def stored(log):
    return sorted((r["source"], r["chunk_index"], r["id"]) for r in log.table().collect())


def interrupted(log, kind, action):
    """The log does something else just before it first publishes an entry of this kind."""
    publish, waiting = log.log._publish, [action]

    def hooked(version, entry):
        if entry["kind"] == kind and waiting:
            waiting.pop()()
        return publish(version, entry)

    log.log._publish = hooked


@pytest.fixture
def root(spark):
    return scratch_path(spark, "vectors")


def test_two_writers(spark, root):
    """The slower writer keeps its ids and comes after the faster one."""
    one, two = VectorLog(spark, root), VectorLog(spark, root)
    interrupted(one, "append", lambda: two.append(chunks(spark, "b", 4), SETTINGS))
    assert one.append(chunks(spark, "a", 3), SETTINGS) == 1
    assert stored(one) == [("a", i, 1 + i) for i in range(3)] + [("b", i, 4 + i) for i in range(4)]
    interrupted(one, "reserve", lambda: two.append(chunks(spark, "d", 2), SETTINGS))
    assert one.append(chunks(spark, "c", 1), SETTINGS) == 10
    assert [r for r in stored(two) if r[0] in "cd"] == [("c", 0, 10), ("d", 0, 8), ("d", 1, 9)]
    assert two.append(chunks(spark, "e", 0), SETTINGS) == 11 and len(stored(two)) == 10


def test_a_writer_that_dies(spark, root):
    """Rows and vectors written before the entry are never seen; their ids stay unused."""
    log = VectorLog(spark, root)
    log.append(chunks(spark, "a", 5), SETTINGS)
    log.build_index(Quantising(lists=2, parts=4))

    def die():
        raise KeyboardInterrupt

    dying = VectorLog(spark, root)
    interrupted(dying, "append", die)
    with pytest.raises(KeyboardInterrupt):
        dying.append(chunks(spark, "lost", 7), SETTINGS)
    assert len(stored(log)) == 5
    assert log.append(chunks(spark, "b", 2), SETTINGS) == 13
    query = log.table().where("source = 'b' AND chunk_index = 1").first()["embedding"]
    assert [r["id"] for r in log.search(query, 1, columns=["id"]).collect()] == [14]
    every = log.table().select(F.col("id").alias("query_id"), "embedding")
    assert log.search_many(every, 7).select("id").distinct().count() == 7


def test_an_index_and_a_writer_at_once(spark, root):
    """Whichever is first, all vectors are in the index."""
    log, other = VectorLog(spark, root), VectorLog(spark, root)
    with pytest.raises(ValueError):
        log.search([1.0] * 16)
    log.append(chunks(spark, "a", 20), SETTINGS)
    interrupted(log, "index", lambda: other.append(chunks(spark, "b", 3), SETTINGS))
    log.build_index(Quantising(lists=2, parts=4))
    again = VectorLog(spark, root)
    interrupted(again, "append", lambda: other.build_index(Quantising(lists=3, parts=4)))
    again.append(chunks(spark, "c", 4), SETTINGS)
    every = log.table().select(F.col("id").alias("query_id"), "embedding")
    assert {r["id"] for r in log.search_many(every, 27).where("query_id = 1").collect()} == set(range(1, 28))


def test_index_follows_the_table(spark, root, monkeypatch):
    """Four times the rows in a new cluster: the index is trained anew, the recall stays."""
    rows = {"old": clustered(spark, 0, 200, [0.0] * 16, 5), "new": clustered(spark, 0, 800, [3.0] * 16, 6)}
    log = VectorLog(spark, root)
    for name, own in rows.items():
        vectors = frame(spark, own).withColumnRenamed("id", "place")
        given = chunks(spark, name, len(own)).join(vectors, F.col("chunk_index") == F.col("place")).drop("place")
        log.append(given, SETTINGS)
        assert log.refresh_index(SMALL) and not log.refresh_index(SMALL)
        queries = log.table().where("id % 9 = 0").select(F.col("id").alias("query_id"), "embedding")
        assert ann.recall(log.search_many(queries, 5), search.search_many(log.table(), queries, 5)).first()["recall"] >= 0.9
    assert not VectorLog(spark, root + "x").refresh_index(SMALL)


def test_stored_by_the_plans(spark, root):
    """With a log in the settings, chunks go there and to its index."""
    settings = dataclasses.replace(SETTINGS, vector_log=root)
    vectors.ensure_table(spark, settings)
    assert vectors.store_chunks(spark, chunks(spark, "a", 3), settings) == 1
    assert vectors.store_chunk(spark, "b", "b.pdf", 0, "b", [1.0] * 16, settings=settings) == 4
    assert [r[:2] for r in stored(VectorLog(spark, root))] == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    assert vectors.store_chunks(spark, chunks(spark, "a", 4), settings, dedupe=True) == 5
    assert len(vectors.stored_table(spark, settings).collect()) == 5


def test_dedupe_against_a_faster_writer(spark, root):
    one, two = VectorLog(spark, root), VectorLog(spark, root)
    one.append(chunks(spark, "a", 2), SETTINGS)
    interrupted(one, "append", lambda: two.append(chunks(spark, "b", 3), SETTINGS, dedupe=True))
    both = chunks(spark, "a", 3).union(chunks(spark, "b", 4))
    one.append(both, SETTINGS, dedupe=True)
    assert [r[:2] for r in stored(two)] == [("a", i) for i in range(3)] + [("b", i) for i in range(4)]
    one.append(both, SETTINGS)
    assert len(stored(two)) == 14


def test_many_entries(spark, root, monkeypatch):
    """Writers in threads, and states read from snapshots on."""
    monkeypatch.setattr(commits, "SNAPSHOT", 4)
    got = []

    def reserve():
        log = CommitLog(spark, root)
        for _ in range(5):
            _, entry = log.commit(lambda s: {"kind": "reserve", "first_id": s.next_id, "rows": 3})
            got.append(entry["first_id"])

    threads = [threading.Thread(target=reserve) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [1 + 3 * i for i in range(20)]
    log = CommitLog(spark, root)
    assert log.state() == commits.State(19, 61)
    (version,) = [v for v in log._versions() if v == 18]
    log._store.delete(log._path(f"{version:020d}.json"), False)
    assert log.state().version == 19
    log._store.delete(log._path(f"{19:020d}.json"), False)
    log._store.delete(log._path(f"{16:020d}.json"), False)
    with pytest.raises(ValueError, match="gaps"):
        log.state()
    with pytest.raises(ValueError, match="unknown"):
        commits.State().after({"kind": "x"})


def same_hits(spark, rows, asked, top_k, settings):
    """Pivots against all with all; returns the share of the pairs that were compared."""
    compared = spark.sparkContext.accumulator(0)
    table = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(5)
    queries = spark.createDataFrame(asked, "query_id long, embedding array<float>")
    found = pivots.search_by_pivots(table, queries, top_k, settings, compared).collect()
    exact = search.search_many(table, queries.where("embedding IS NOT NULL"), top_k).collect()

    def told(hits):
        rows = [(r["query_id"], r["rank"], r["id"], r["similarity"]) for r in hits]
        return sorted((q, n, i, None if s is None or s != s else round(s, 9)) for q, n, i, s in rows)

    assert told(found) == told(exact)
    return compared.value / max(1, len(rows) * len(asked))


def test_pivots(spark):
    """The hits of comparing all with all, with far fewer comparisons where there are clusters."""
    random = np.random.default_rng(8)
    rows = []
    for k in range(25):
        centre = random.normal(0, 1, 24)
        rows += [(100 * k + i, (centre + random.normal(0, 0.12, 24)).tolist()) for i in range(80)]
    rows += [(9000 + i, rows[5][1]) for i in range(30)]
    asked = [(i, v) for i, v in rows[::9]]
    share = same_hits(spark, rows, asked, 10, Pivots(cells=64, per_cell=40, block=16))
    assert 0 < share < 0.15
    # Without clusters nothing can be left out, and nothing is lost.
    loose = [(i, random.normal(0, 1, 24).tolist()) for i in range(400)]
    assert same_hits(spark, loose, loose[:20], 7, Pivots(per_cell=30, block=8)) <= 1
    # One cell, and more hits than a cell holds.
    assert same_hits(spark, rows, asked[:5], 300, Pivots(cells=64, per_cell=40)) < 1
    assert same_hits(spark, rows, asked[:5], 3, Pivots(cells=1)) <= 1


def test_pivots_of_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 1e-6]), (5, [-1.0, 0.0]), (6, [1.0, 0.0])]
    asked = [(10, [1.0, 0.0]), (11, [0.0, 0.0]), (12, None)]
    for top_k in (1, 3, 5, 9):
        same_hits(spark, rows, asked, top_k, Pivots(per_cell=1, block=1))
    same_hits(spark, rows[1:3], asked, 2, Pivots())
    same_hits(spark, rows, asked[2:], 2, Pivots())


def test_pivots_shuffle_their_groups(spark):
    # The groups hold a query's vector once for each cell: they never pass through the driver.
    rows = np.random.default_rng(9).normal(size=(400, 8)).tolist()
    table = spark.createDataFrame(list(enumerate(rows)), "id long, embedding array<float>")
    queries = table.where("id % 5 = 0").withColumnRenamed("id", "query_id")
    hits = pivots.search_by_pivots(table, queries, 5, Pivots(8, 20, 4))
    compared = hits.select("query_id")._jdf.queryExecution().executedPlan().toString().split("MapInArrow", 1)[1]
    assert compared.index("SortMergeJoin") < compared.index("Broadcast")
    named = ["query_id", "rank", "id"]
    exact = search.search_many(table, queries, 5)
    assert sorted(hits.select(*named).collect()) == sorted(exact.select(*named).collect())
