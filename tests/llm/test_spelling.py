"""Spelling variants against brute force over all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import pytest

from folia.llm import catalog, spelling
from folia.llm.spelling import Spelling


def plain_words(rows, settings=Spelling()):
    counts = Counter()
    for doc_id, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall(r"[a-zÀ-ÿ]+", low):
            code = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if code % settings.spoilt == 0:
                at = code % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= settings.letters and n >= settings.occurrences}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    rows = {}
    for word, n in counts.items():
        near = [w for w in counts if abs(len(w) - len(word)) < 2 and one_apart(w, word)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        rows[word] = [n, form, counts[form] if form else None, len(near)]
    for word in rows:
        root = word
        while rows[root][1] is not None:
            root = rows[root][1]
        rows[word].append(root)
    return {w: tuple(r) for w, r in rows.items()}


def found(frame):
    rows = frame.select("word", "n", "form", "form_n", "n_near", "root").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("bucket", [2, 7, 4000])
@pytest.mark.parametrize("letters", ["ab", "abcdefé"])
def test_near_words(spark, letters, bucket):
    """Every pair once, also where buckets are halved until one letter is left."""
    source = random.Random(bucket)
    drawn = {"".join(source.choices(letters, k=source.choice([5, 6, 6, 7, 9]))) for _ in range(150)}
    base = "".join(source.choices(letters, k=12))
    drawn |= {base[:i] + c + base[i + k :] for i in range(13) for c in letters for k in (0, 1)}
    counts = {w: source.choice([3, 3, 4, 7, 30]) for w in drawn}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    settings = Spelling(bucket=bucket)
    near = {r[0]: tuple(r)[1:] for r in spelling.near_words(words, settings).collect()}
    expected = {}
    for word in counts:
        others = [w for w in counts if one_apart(w, word)]
        if others:
            expected[word] = len(others), min(others, key=lambda w: (-counts[w], w))
    assert {w: r[:2] for w, r in near.items()} == expected
    assert all(counts[best] == n for _, best, n in near.values())


def test_roots(spark):
    """A chain of forms is followed to its end, many words share one."""
    forms = [(f"w{i}", f"w{i + 1}") for i in range(21)] + [(f"x{i}", "w3") for i in range(50)]
    rows = spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()
    assert {r[0]: r[1] for r in rows} == {w: "w21" for w, _ in forms}
    assert spelling.roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_awkward(spark, awkward, empty, monkeypatch):
    """NULL texts and ids, copies, repeated rows, long words, clashing columns, no rows."""
    monkeypatch.setattr(spelling, "_COUNTED", 20)
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    long = "y" * 3000
    rows += [(100 + i, f"{long} {long}z ÀÈ×éa {long[:-1]}q Aéé-Zéé x́abcde") for i in range(4)]
    docs = awkward.select("doc_id", "text", awkward.kept.alias("word"), awkward.spans.alias("n"))
    more = spark.createDataFrame([(*r, "x", "y") for r in rows[-4:]], docs.schema)
    for settings in (Spelling(), Spelling(letters=2, occurrences=1, spoilt=3, bucket=9)):
        counts = plain_words(rows, settings)
        assert counts
        assert found(spelling.spelling_groups(docs.union(more), settings)) == plain_groups(counts)
    assert spelling.spelling_groups(empty).count() == 0
    with pytest.raises(ValueError):
        Spelling(letters=1)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    counts = plain_words(rows)
    assert found(catalog.op11_position_index(spark, sf)) == plain_groups(counts)


def test_queries_with_sql(spark):
    """The queries that have SQL give its rows."""
    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for name in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    for name, sql in catalog.ORACLES.items():
        frame = catalog.QUERIES[name](spark, sf)
        told = duck.execute(f"SELECT {', '.join(frame.columns)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, frame.collect()), key=str) == sorted(told, key=str)
