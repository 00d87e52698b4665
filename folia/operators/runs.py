"""Bookkeeping of scheduled runs: what is pending, what came out, what failed."""

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from folia.functions.naming import dead_letter_path
from folia.operators.documents import NOT_EXTRACTED
from folia.session import materialise
from folia.sources.objects import pdfs, without_control_files


def pending_files(listing: DataFrame, processed: DataFrame) -> DataFrame:
    """PDFs outside the control folder whose URI is not in the index.

    Both sides may be large; the join is on the URI and carries no document text.
    """
    eligible = without_control_files(pdfs(listing))
    return eligible.join(processed.select("uri"), "uri", "left_anti")


def capped(pending: DataFrame, max_files: int | None) -> DataFrame:
    """The first files of a run, in listing order; all of them without a number."""
    return pending if max_files is None else pending.orderBy("name").limit(max_files)


def discovery_counts(pending: DataFrame, max_files: int | None) -> DataFrame:
    taken = F.count("*") if max_files is None else F.least(F.count("*"), F.lit(max_files))
    return pending.agg(F.count("*").alias("pending"), taken.alias("taken"))


def attach_extracted(files: DataFrame, extracted: DataFrame) -> DataFrame:
    """The extracted document of every file; files without one get an error.

    The documents are joined with the list of files, which Spark sends to all tasks if it
    is small enough; which files have no document is found by the URIs alone.
    """
    wanted = materialise(files.select("uri", "name"), "wanted")
    documents = extracted.drop("name")
    missing = wanted.join(documents.select("uri"), "uri", "left_anti")
    return documents.join(wanted, "uri").unionByName(
        missing.withColumn("error", F.lit(NOT_EXTRACTED)), allowMissingColumns=True
    )


def outcomes(processed: DataFrame) -> DataFrame:
    """One row per file: success with path and chunk count, or failure with its error.

    A success is named by its base name, a failure by its full object name.
    """
    ok = F.col("error").isNull()
    return processed.select(
        F.when(ok, "success").otherwise("failed").alias("status"),
        F.col("source").alias("gcs_uri"),
        F.when(ok, F.col("output_path")).alias("output_path"),
        F.when(ok, F.col("text_chunk_count")).alias("chunk_count"),
        F.when(ok, F.col("filename")).otherwise(F.col("name")).alias("filename"),
        "error",
    )


def with_errors(processed: DataFrame, failed: DataFrame) -> DataFrame:
    """Processed documents with the errors that came up after processing, by ``source``."""
    later = failed.select("source", F.col("error").alias("_later"))
    joined = processed.join(later, "source", "left")
    return joined.withColumn("error", F.coalesce("error", "_later")).select(processed.columns)


def successes(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") == "success")


def failures(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") != "success")


def dead_letters(results: DataFrame) -> DataFrame:
    """Where the record of each failure goes, and the record as JSON."""
    record = F.struct("status", "gcs_uri", "filename", "error")
    return failures(results).select(
        dead_letter_path(F.col("filename")).alias("path"), F.to_json(record).alias("record")
    )


def write_dead_letters(results: DataFrame, path: str, run: str) -> None:
    """Write the failures of a run; repeating the run replaces them."""
    stamped = dead_letters(results).withColumn("written_at", F.lit(time.time_ns() // 1000))
    stamped.write.mode("overwrite").json(f"{path}/run={run}")


def current_dead_letters(spark: SparkSession, path: str, processed: DataFrame) -> DataFrame:
    """The latest record of each failed file that has not been processed since."""
    schema = "path string, record string, written_at long, run string"
    written = spark.read.schema(schema).json(path)
    order = F.struct("written_at", "run")
    latest = written.groupBy("path").agg(F.max_by(F.struct("record", "run"), order).alias("last"))
    current = latest.select("path", "last.*").withColumn(
        "uri", F.get_json_object("record", "$.gcs_uri")
    )
    return current.join(processed.select("uri"), "uri", "left_anti").select("path", "record", "run")


def run_summary(results: DataFrame) -> DataFrame:
    failed = F.col("status") != "success"
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(~failed).alias("passed"),
        F.count_if(failed).alias("failed"),
    )
