"""Batch jobs: process a prefix, write results, embed and store."""

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from folia.config import Settings
from folia.functions.naming import basename, object_uri
from folia.operators.documents import process, succeeded
from folia.operators.embedding import failed_documents, without_failed
from folia.session import materialise
from folia.sources.objects import pdfs, under_prefix
from folia.sources.results import (
    keep_path_winners,
    read_results,
    result_chunks,
    run_folder,
    with_output_path,
    write_results,
)
from folia.sources.vectorrows import Embed, vector_rows
from folia.sources.vectors import ensure_table, store_chunks


def select_pdfs(extracted: DataFrame, prefix: str = "") -> DataFrame:
    return pdfs(under_prefix(extracted, prefix))


def process_prefix(
    extracted: DataFrame, prefix: str = "", settings: Settings = Settings()
) -> DataFrame:
    """Full records of all PDFs under a prefix; documents that failed are left out.

    One scan of the documents, without a shuffle.
    """
    selected = select_pdfs(extracted, prefix)
    return with_output_path(succeeded(process(selected, settings)))


def result_files(selected: DataFrame) -> DataFrame:
    """Source, name and output path of every file that has a result; reads no text."""
    named = succeeded(selected).select(
        F.col("uri").alias("source"), "name", basename(F.col("uri")).alias("filename")
    )
    return with_output_path(named)


def output_uris(files: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The URI of the result of every processed file."""
    return files.select(
        "source",
        object_uri(settings.output_bucket, F.col("output_path")).alias("output_uri"),
    )


def embed_and_store(
    processed: DataFrame,
    settings: Settings = Settings(),
    dedupe: bool = False,
    embed: Embed | None = None,
) -> DataFrame:
    """Append the chunks of processed documents to the vector table.

    Returns ``source`` and ``error`` of the documents that ``embed`` marks as failed in a column
    ``error``; none of their chunks is stored.
    """
    spark = processed.sparkSession
    ensure_table(spark, settings)
    chunks = result_chunks(processed)
    embedded = embed(chunks) if embed is not None else chunks
    if "error" not in embedded.columns:
        store_chunks(spark, chunks, settings, dedupe, embed)
        return spark.createDataFrame([], "source string, error string")
    embedded = materialise(embedded, "embedded")
    failed = materialise(failed_documents(embedded), "failed")
    store_chunks(spark, without_failed(embedded, failed), settings, dedupe)
    return failed


def stored_view(processed: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """What :func:`embed_and_store` would put into an empty table."""
    return vector_rows(result_chunks(processed), settings.embedding_dimensions)


def run_name() -> str:
    """A name for a run; later runs sort after earlier ones."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")


@dataclass(frozen=True)
class BatchRun:
    processed: DataFrame
    outputs: DataFrame
    # Documents whose chunks could not be embedded, with the model's message.
    failed: DataFrame | None = None


def run_batch(
    extracted: DataFrame,
    results_path: str | None,
    prefix: str = "",
    store: bool = False,
    settings: Settings = Settings(),
    run: str | None = None,
    dedupe: bool = False,
    embed: Embed | None = None,
) -> BatchRun:
    """Process a prefix; write the result records (if a path is given) and store the vectors.

    ``outputs`` has the URI that names each result and, in ``stored_at``, the folder that
    holds its record. ``embed`` is a model's step, see ``sources.vectorrows.vector_rows``.
    """
    run = run or run_name()
    processed = process_prefix(extracted, prefix, settings)
    files = result_files(select_pdfs(extracted, prefix))
    if store:
        # Both sinks, and the sampling that orders the ids, read the stored rows.
        processed = materialise(processed, "processed")
    if results_path:
        write_results(keep_path_winners(processed, files), results_path, run)
    failed = embed_and_store(processed, settings, dedupe, embed) if store else None
    stored_at = F.lit(run_folder(results_path, run) if results_path else None).cast("string")
    outputs = output_uris(files, settings).withColumn("stored_at", stored_at)
    return BatchRun(processed, outputs, failed)


def store_results(
    spark: SparkSession,
    path: str,
    settings: Settings = Settings(),
    multi_line: bool = False,
    dedupe: bool = False,
    embed: Embed | None = None,
) -> DataFrame:
    """Embed and store the chunks of results written earlier; returns the documents that failed."""
    return embed_and_store(read_results(spark, path, multi_line), settings, dedupe, embed)
