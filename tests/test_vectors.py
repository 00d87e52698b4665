"""Embedding, search and the vector table."""

import hashlib
import json
import math
import re
import uuid

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from folia.checks.catalog import QUERIES
from folia.config import Settings
from folia.functions.hashing import hash_embedding
from folia.functions.vectors import cosine_similarity
from folia.operators import ann, search
from folia.operators.embedding import embed_query, embed_texts, embed_with_model, zip_embeddings
from folia.operators.ids import with_dense_ids
from folia.session import scratch_path
from folia.sources import vectors


def hashed(text, dims):
    counts = [0] * dims
    for word in re.findall(r"\w+", text.lower()):
        counts[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dims] += 1
    norm = math.sqrt(sum(n * n for n in counts)) or 1
    return [n / norm for n in counts]


@pytest.mark.parametrize("dims", [1, 8, 768])
def test_hash_embedding(apply, dims):
    texts = ["", "a", "a b a", "x y z " * 40, "É é é", "... !"]
    found = apply(lambda text: hash_embedding(text, dims), texts)
    for text, vector in zip(texts, found):
        assert vector == pytest.approx(hashed(text, dims), abs=1e-6)


def test_query_and_batch_agree(spark):
    frame = spark.createDataFrame([("one two",), ("three",)], "content STRING")
    rows = embed_texts(frame, "content", 16).collect()
    assert [embed_query(spark, r.content, 16) for r in rows] == [r.embedding for r in rows]


def test_model_hook_keeps_rows_and_order(spark):
    def load():
        return lambda texts: [[float(len(text)), 1.0] for text in texts]

    frame = spark.createDataFrame([(i, "x" * i) for i in range(20)], "id INT, content STRING")
    rows = embed_with_model(frame.repartition(3), "content", load).collect()
    assert {r.id: list(r.embedding) for r in rows} == {i: [float(i), 1.0] for i in range(20)}


def test_model_hook_checks_the_number_of_vectors(spark):
    frame = spark.createDataFrame([(1, "x")], "id INT, content STRING")
    with pytest.raises(PySparkException, match="another number of vectors"):
        embed_with_model(frame, "content", lambda: lambda texts: []).collect()


PAIRS = (
    "source STRING, chunks ARRAY<STRUCT<chunk_index INT, content STRING>>, "
    "embeddings ARRAY<ARRAY<FLOAT>>"
)


def test_zip_embeddings(spark):
    frame = spark.createDataFrame(
        [("s", [(5, "a"), (None, "b")], [[0.5], [1.5]]), ("t", [], [])], PAIRS
    )
    rows = zip_embeddings(frame, "chunks", "embeddings").collect()
    assert sorted(map(tuple, rows)) == [("s", 1, "b", [1.5]), ("s", 5, "a", [0.5])]


def test_zip_embeddings_of_unequal_length_is_an_error(spark):
    frame = spark.createDataFrame([("s", [(0, "hello")], [[0.1], [0.2]])], PAIRS)
    with pytest.raises(PySparkException, match="must have the same length"):
        zip_embeddings(frame, "chunks", "embeddings").collect()


# Search.


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(600, 8)).astype(np.float32)
    rows[100:300] = rows[42]  # a third of all vectors are equal
    return rows


@pytest.fixture(scope="module")
def table(spark, matrix):
    rows = [(i, "s", "f", i, f"text {i}", "{}", row.tolist()) for i, row in enumerate(matrix)]
    rows += [(600, "s", "f", 0, "zero", "{}", [0.0] * 8), (601, "s", "f", 0, "none", "{}", None)]
    schema = (
        "id BIGINT, source STRING, filename STRING, chunk_index INT, content STRING, "
        "metadata STRING, embedding ARRAY<FLOAT>"
    )
    return spark.createDataFrame(rows, schema).repartition(5, "id").cache()


def ranked(matrix, query):
    rows = matrix.astype(float)
    scores = rows @ query / np.linalg.norm(rows, axis=1) / np.linalg.norm(query)
    return sorted(range(len(rows)), key=lambda i: (-round(scores[i], 9), i)), scores


@pytest.mark.parametrize("top_k", [1, 10, 250])
def test_search_against_brute_force(table, matrix, top_k):
    query = matrix[42] + 0.1
    order, scores = ranked(matrix, query)
    hits = search.similarity_search(table, query, top_k).collect()
    assert [h.id for h in hits] == order[:top_k]
    assert [h.similarity for h in hits] == pytest.approx([scores[i] for i in order[:top_k]])
    assert hits[0].content == f"text {hits[0].id}"


def test_zero_and_missing_vectors_come_last(table, matrix):
    hits = search.similarity_search(table, matrix[0], 700, ["id"]).collect()
    assert [h.id for h in hits][-2:] == [600, 601]
    assert math.isnan(hits[-2].similarity) and hits[-1].similarity is None
    assert len(hits) == 602


def test_search_many_in_one_or_many_blocks(spark, table, matrix, monkeypatch):
    asked = [(f"q{i}", matrix[i * 7].tolist()) for i in range(30)]
    queries = spark.createDataFrame(asked, "query_id STRING, embedding ARRAY<FLOAT>")
    whole = search.search_many(table, queries, 12)
    rows = {(r.query_id, r.rank): r.id for r in whole.collect()}
    monkeypatch.setattr(search, "_QUERY_BLOCK", 7)
    monkeypatch.setattr(search, "_VECTOR_BLOCK", 50)
    sliced = search.search_many(table, queries, 12)
    assert rows == {(r.query_id, r.rank): r.id for r in sliced.collect()}
    for name, vector in asked:
        order, _ = ranked(matrix, np.array(vector))
        assert [rows[name, rank] for rank in range(1, 13)] == order[:12]


def test_search_of_nothing(spark, table, matrix):
    nothing = table.where("id < 0").repartition(3)
    assert search.similarity_search(nothing, matrix[0]).collect() == []
    queries = spark.createDataFrame([(1, matrix[0].tolist())], "query_id INT, embedding ARRAY<FLOAT>")
    assert search.search_many(nothing, queries).collect() == []
    assert search.search_many(table, queries.limit(0)).collect() == []


def test_cosine_similarity_column(spark):
    frame = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0])],
        "a ARRAY<FLOAT>, b ARRAY<FLOAT>",
    )
    found = [r[0] for r in frame.select(cosine_similarity(F.col("a"), F.col("b"))).collect()]
    assert found[0] == pytest.approx(math.sqrt(0.5))
    assert math.isnan(found[1]) and found[2] is None


def test_report(spark):
    hits = spark.createDataFrame(
        [(2, "s", "f.pdf", 3, "x\n" * 150, "{}", 0.87654), (1, "s", "g.pdf", 0, "a\nb", "{}", 0.95)],
        "id BIGINT, source STRING, filename STRING, chunk_index INT, content STRING, "
        "metadata STRING, similarity DOUBLE",
    )
    first, second = search.report(hits).orderBy("rank").collect()
    assert tuple(first) == (1, "0.950", "g.pdf#chunk-0", "s", "a b")
    assert second.score == "0.877" and second.preview == "x " * 100 + "..."


def test_vector_from_json():
    assert search.vector_from_json("[1, 0.5]") == [1.0, 0.5]


VECTOR = "id BIGINT, embedding ARRAY<FLOAT>"


def test_ann_recall_widening_and_appends(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 32))
    rows = np.repeat(centres, 40, axis=0) + rng.normal(size=(800, 32)) * 0.3
    frame = [(i, row.tolist()) for i, row in enumerate(rows)] + [(800, [0.0] * 32), (801, None)]
    table = spark.createDataFrame(frame, VECTOR)
    path = scratch_path(spark, "ann")
    ann.build_index(table, path, lists=16)
    stored = spark.read.parquet(f"{path}/lists")
    assert stored.count() == 800 == stored.select("id").distinct().count()
    found = 0
    for i in range(0, 800, 80):
        near = ann.ann_search(table, path, rows[i], 10, 4, ["id"]).collect()
        exact = search.similarity_search(table, rows[i], 10, ["id"]).collect()
        found += len({r.id for r in near} & {r.id for r in exact})
    assert found >= 90
    # Too few in the nearest list: further lists are searched.
    assert ann.ann_search(table, path, rows[0], 700, 1, ["id"]).count() == 700
    assert ann.ann_search(table, path, rows[0], 900, 1, ["id"]).count() == 800
    # A vector appended later is found.
    more = spark.createDataFrame([(900, rows[3].tolist())], VECTOR)
    ann.add_to_index(more, path)
    hit = ann.ann_search(table.union(more), path, rows[3], 2, 1, ["id"]).collect()
    assert {r.id for r in hit} == {3, 900}


def test_ann_search_of_many_queries(spark):
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(600, 16))
    table = spark.createDataFrame([*((i, row.tolist()) for i, row in enumerate(rows)), (601, None)], VECTOR)
    path = scratch_path(spark, "ann")
    ann.build_index(table, path, lists=12)
    queries = table.where("id % 50 = 0").withColumnRenamed("id", "query_id")
    found = ann.ann_search_many(spark, path, queries, 10, 3).collect()
    for i in range(0, 600, 50):
        own = sorted((r.rank, r.id) for r in found if r.query_id == i)
        one = ann.ann_search(table, path, rows[i], 10, 3, ["id"]).collect()
        assert [x for _, x in own] == [r.id for r in one]
    exact = search.search_many(table, queries)
    every = ann.ann_search_many(spark, path, queries, 10, 12)
    assert ann.recall(every, exact).first() == (12, 1.0)
    assert 0.3 < ann.recall(ann.ann_search_many(spark, path, queries, 10, 3), exact).first()["recall"] < 1
    # Too few in the lists: further ones are searched.
    assert ann.ann_search_many(spark, path, queries, 550, 1).count() == 12 * 550


def test_stored_chunks_are_in_the_index(spark):
    name = "indexed_" + uuid.uuid4().hex[:8]
    index = scratch_path(spark, "ann")
    settings = Settings(vector_table=name, embedding_dimensions=16, vector_index=index)
    vectors.ensure_table(spark, settings, scratch_path(spark, "vectors"))
    plain = Settings(vector_table=name, embedding_dimensions=16)
    first = vectors.store_chunk(spark, "s", "f", 0, "one", [1.0] + [0.0] * 15, settings=plain)
    ann.build_index(spark.table(name), index, lists=2)
    later = vectors.store_chunk(spark, "s", "f", 1, "two", [0.0, 1.0] + [0.0] * 14, settings=settings)
    hit = ann.ann_search(spark.table(name), index, [0.0, 1.0] + [0.0] * 14, 2, 2, ["id"]).collect()
    assert [r.id for r in hit] == [later, first]


# The table.

CHUNKS = "source STRING, filename STRING, chunk_index INT, content STRING, metadata STRING"


@pytest.fixture
def settings(spark):
    name = f"chunks_{uuid.uuid4().hex}"
    made = Settings(vector_table=name, embedding_dimensions=4)
    vectors.ensure_table(spark, made, scratch_path(spark, name))
    yield made
    spark.sql(f"DROP TABLE {name}")


def test_store_and_append(spark, settings):
    chunks = spark.createDataFrame(
        [(f"s{d}", "f", i, f"text {i}", None) for d in range(5) for i in range(20)], CHUNKS
    )
    vectors.store_chunks(spark, chunks.repartition(4), settings)
    vectors.ensure_table(spark, settings)
    stored = spark.table(settings.vector_table)
    rows = stored.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, 101))
    assert [(r.source, r.chunk_index) for r in rows] == [
        (f"s{d}", i) for d in range(5) for i in range(20)
    ]
    assert {r.metadata for r in rows} == {"{}"}
    assert all(len(r.embedding) == 4 and r.created_at for r in rows)

    vectors.store_chunks(spark, chunks, settings)
    assert stored.count() == 200
    assert stored.agg(F.countDistinct("id"), F.max("id")).first()[:] == (200, 200)

    vectors.store_chunks(spark, chunks, settings, dedupe=True)
    assert stored.count() == 200


def test_store_one(spark, settings):
    for expected in (1, 2):
        assert (
            vectors.store_chunk(
                spark, "s", "f", 0, "hi", [0.1, 0.2, 0.3, 0.4], '{"a":1}', settings
            )
            == expected
        )
    row = spark.table(settings.vector_table).first()
    assert json.loads(row.metadata) == {"a": 1}


def test_wrong_size_and_missing_values_are_errors(spark, settings):
    with pytest.raises(PySparkException, match="expected 4 dimensions"):
        vectors.store_chunk(spark, "s", "f", 0, "hi", [0.1], settings=settings)
    with pytest.raises(PySparkException, match="must not be NULL"):
        vectors.store_chunk(spark, "s", None, 0, "hi", [0.1] * 4, settings=settings)
    assert spark.table(settings.vector_table).count() == 0


def test_dense_ids_with_a_hot_key(spark):
    frame = spark.range(3000).select((F.col("id") % 3 * 0).alias("hot"), F.col("id").alias("n"))
    rows = with_dense_ids(frame.repartition(6), ["hot", "n"], 11).collect()
    assert {r.n: r.id for r in rows} == {n: n + 11 for n in range(3000)}


def test_ann_recall_says_what_the_lists_find(spark):
    found = QUERIES["ann_recall"](spark, "/root/testdata/sf0.001").first()
    assert found.queries == 10 and 0 < found.recall < 1
    assert found.found_enough and found.read_few


def test_embedding_counts_batches_of_words(spark):
    from folia.functions import hashing

    texts = ["", "a b a", "Straße ΣΑΣ ΑΣ", "İstanbul I", "x" * 50, None, *(chr(i) + "A b" + chr(i) for i in range(0x250))]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    picked = F.transform(hashing.tokens(F.col("text")), lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % 16)
    made = frame.select("text", picked.alias("picked"), hash_embedding(F.col("text"), 16).alias("vector"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan
    for row in made.collect():
        if row.text is None:
            assert row.vector is None
            continue
        counts = np.bincount(row.picked, minlength=16) if row.picked else np.zeros(16)
        assert row.vector == pytest.approx((counts / max(1, np.sqrt((counts * counts).sum()))).astype(np.float32).tolist(), abs=0)
