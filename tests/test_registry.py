"""Every registered query against its SQL, and the settings."""

import math

import duckdb
import pytest

import __spark_entry__ as registry
from folia.checks.catalog import ORACLES, QUERIES
from folia.config import Settings

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(rows, columns):
    def value(x):
        return None if isinstance(x, float) and math.isnan(x) else x

    return sorted((tuple(value(row[c]) for c in columns) for row in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = registry.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    found = comparable(frame.collect(), columns)
    assert found
    if name not in registry.oracle_sql():
        return
    result = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    expected = comparable([dict(zip(names, row)) for row in result.fetchall()], columns)
    assert sorted(names) == columns
    assert len(found) == len(expected)
    for ours, theirs in zip(found, expected):
        assert ours == pytest.approx(theirs, abs=2e-6) if _numbers(ours) else ours == theirs


def _numbers(row):
    return all(isinstance(x, (int, float)) for x in row)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_settings(monkeypatch):
    assert Settings() == Settings.from_env() == Settings("corporate-raw-docs", "corporate-processed-docs", 1024, 200, 768, "document_chunks", 50, 10)
    monkeypatch.setenv("CHUNK_SIZE", "512")
    monkeypatch.setenv("CHUNK_OVERLAP", "64")
    monkeypatch.setenv("VECTOR_TABLE", "test_chunks")
    given = Settings.from_env()
    assert (given.chunk_size, given.chunk_overlap, given.vector_table) == (512, 64, "test_chunks")
    with pytest.raises(ValueError):
        Settings(chunk_size=10, chunk_overlap=11)
