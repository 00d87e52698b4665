import random

import pytest
from pyspark.sql import functions as F

from folia.config import Settings
from folia.functions.splitting import split_pieces, split_text
from folia.operators.documents import chunk_rows, chunk_rows_with_overlap
from tests.plain_split import split


def chunked(apply, texts, size, overlap):
    return apply(lambda text: split_text(text, size, overlap), texts)


def test_random_texts_as_without_spark(apply):
    rng = random.Random(7)
    alphabets = ["ab \n", "ab.! ?;,\n ", "a\n", "abcdefgh  ,\x01\n. ", " \n", "　a \n", "\U0001d7d8 a,"]
    texts = [
        "".join(rng.choices(rng.choice(alphabets), k=rng.choice([0, 1, 5, 30, 80, 300])))
        for _ in range(1500)
    ]
    for size, overlap in ((20, 5), (10, 10), (33, 0), (1, 0)):
        assert chunked(apply, texts, size, overlap) == [split(t, size, overlap) for t in texts]


def test_long_runs_overlap(apply):
    words = " ".join(["tide"] * 500)
    assert [len(c) for c in chunked(apply, [words], 512, 64)[0]] == [509] * 5 + [249]


def test_edges(apply):
    word = "x" * 5000
    exact = "a b " * 2 + "cc"
    texts = ["", "short", word, exact, " " + word + " ", "\n\n".join(["p" * 9] * 3)]
    assert chunked(apply, texts, 10, 2) == [
        [],
        ["short"],
        [word],
        [exact],
        [" " + word],
        # Cut again at the single line break, then as long as the limit and left as it is.
        ["p" * 9, "\n" + "p" * 9, "\n" + "p" * 9],
    ]


def test_pieces_rebuild_the_text(apply):
    texts = ["Ebb. Flow! Slack? " * 20, "a;b,c d\n\n\ne" * 30, ";\x01;" * 50]
    pieces = apply(lambda text: split_pieces(text, 16), texts)
    assert ["".join(p) for p in pieces] == texts


def test_overlap_larger_than_size_is_an_error():
    with pytest.raises(ValueError):
        split_text(F.col("text"), 10, 11)


def test_chunk_rows(spark):
    frame = spark.createDataFrame(
        [(1, "Low tide now", "log.txt"), (2, "Ebb & flow", None), (3, "Calm..", ""), (4, "", "e")],
        "doc INT, text STRING, source STRING",
    )
    rows = chunk_rows(frame, "text", "source", Settings(chunk_size=512, chunk_overlap=64))
    assert sorted(map(tuple, rows.collect())) == [
        (1, 0, "Low tide now", 12, "log.txt"),
        (2, 0, "Ebb & flow", 10, "unknown"),
        (3, 0, "Calm..", 6, "unknown"),
    ]
    assert chunk_rows_with_overlap is chunk_rows


def test_indices_are_sequential(spark):
    text = "\n\n".join(f"Entry no. {i};" for i in range(20))
    frame = spark.createDataFrame([(text, "s")], "text STRING, source STRING")
    rows = chunk_rows(frame, "text", "source", Settings(chunk_size=40, chunk_overlap=16)).collect()
    assert sorted(r.chunk_index for r in rows) == list(range(len(rows)))
    assert len(rows) > 5
