"""The vector table: created once, appended to, searched.

A batch is appended by one write job, which commits all of its rows or none.
Appending does not look for earlier copies: storing a document twice stores its
chunks twice, unless ``dedupe`` is asked for. In a table of the catalog, ids continue from the
largest stored one, so appends must come from one writer at a time; with ``Settings.vector_log``
the table is a folder that any number of writers append to, see :mod:`folia.sources.vectorlog`.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from folia.config import Settings
from folia.operators.ann import add_to_index
from folia.operators.quantised import add_to_quantised_index, is_quantised
from folia.schemas import VECTORS
from folia.sources.vectorlog import VectorLog
from folia.sources.vectorrows import REQUIRED, Embed, vector_rows


def ensure_table(
    spark: SparkSession, settings: Settings = Settings(), location: str | None = None
) -> None:
    """Create the table if it is not there; with a location, as an external one.

    A log needs no table.
    """
    if settings.vector_log:
        return
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in VECTORS.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {settings.vector_table} ({columns}) USING parquet{where}"
    )


def stored_table(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    """The stored rows, of the table or of the log."""
    if settings.vector_log:
        return VectorLog(spark, settings.vector_log).table()
    return spark.table(settings.vector_table)


def store_chunks(
    spark: SparkSession,
    chunks: DataFrame,
    settings: Settings = Settings(),
    dedupe: bool = False,
    embed: Embed | None = None,
) -> int:
    """Append chunks to the table, and to the index of the settings if there is one.

    Returns the id from which they are numbered.
    """
    if settings.vector_log:
        return VectorLog(spark, settings.vector_log).append(chunks, settings, dedupe, embed)
    stored = spark.table(settings.vector_table)
    last_id = stored.agg(F.max("id")).first()[0] or 0
    rows = vector_rows(
        chunks, settings.embedding_dimensions, last_id + 1, stored if dedupe else None, embed
    )
    rows.write.mode("append").insertInto(settings.vector_table)
    if settings.vector_index:
        added = spark.table(settings.vector_table).where(F.col("id") > last_id)
        add = add_to_quantised_index if is_quantised(spark, settings.vector_index) else add_to_index
        add(added, settings.vector_index)
    return last_id + 1


def store_chunk(
    spark: SparkSession,
    source: str,
    filename: str,
    chunk_index: int,
    content: str,
    embedding: Sequence[float],
    metadata: str | None = None,
    settings: Settings = Settings(),
) -> int:
    """Append one chunk and return its id."""
    names = [*REQUIRED, "embedding", "metadata"]
    chunk = spark.createDataFrame(
        [(source, filename, chunk_index, content, list(embedding), metadata)],
        T.StructType([VECTORS[name] for name in names]),
    )
    return store_chunks(spark, chunk, settings)
