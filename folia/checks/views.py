"""Views of the given tables that exercise every operator, as DataFrames.

:mod:`folia.checks.oracles` defines the same views in SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folia.config import Settings
from folia.functions.naming import object_uri
from folia.sources.spread import spread

BUCKET = Settings().input_bucket
# Dirt by doc_id % 5, see dirty().
PAGE_BREAK = ".\r\n\r\n\r\n42 \nPage 3 of 10\n"
QUOTED = " \u201cthe\u201d\u2014\u2018x\u2019\u2013\u2026\u00a0"
LISTED = ",\x01\x1f\x7f\n- item\n\n\n"
BEFORE = "\u3000\n "
AFTER = "\n7\n| a | b |\n| c | d |\n| e | f |\n| g | h |\n\n"
FAILED = "extraction failed"
# What a body with a repeated key starts with.
REPEATED = '{"bucket":"elsewhere",'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")


def dirty(doc_id: Column, text: Column) -> Column:
    kind = doc_id % 5
    broken = F.replace(F.replace(text, F.lit(" "), F.lit("  \t")), F.lit("er"), F.lit("e-\nr"))
    return (
        F.when(kind == 0, F.replace(text, F.lit(". "), F.lit(PAGE_BREAK)))
        .when(kind == 1, broken)
        .when(kind == 2, F.replace(text, F.lit(" the "), F.lit(QUOTED)))
        .when(kind == 3, F.replace(text, F.lit(", "), F.lit(LISTED)))
        .otherwise(F.concat(F.lit(BEFORE), text, F.lit(AFTER)))
    )


def dirty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = dirty(F.col("doc_id"), F.col("text"))
    return documents(spark, sf_dir).select("doc_id", text.alias("text"))


def file_name(doc_id: Column, source: Column) -> Column:
    suffix = (
        F.when(doc_id % 6 == 0, ".PDF")
        .when(doc_id % 6 == 1, ".txt")
        .when(doc_id % 6 == 2, ".v2.pdf")
        .otherwise(".pdf")
    )
    folder = F.floor(doc_id / 150).cast("bigint").cast("string")
    path = F.concat(source, F.lit("/"), folder, F.lit("/doc_"), (doc_id % 150).cast("string"))
    return F.concat(F.when(doc_id % 50 == 7, "_pipeline/").otherwise(""), path, suffix)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing with one object per document; reads no text."""
    named = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", file_name(F.col("doc_id"), F.col("source")).alias("name")
    )
    return named.select(
        "doc_id",
        object_uri(BUCKET, F.col("name")).alias("uri"),
        "name",
        F.when(F.col("doc_id") % 10 != 9, F.col("n_chars")).alias("size"),
        F.when(
            F.col("doc_id") % 9 != 0, F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 61)
        ).alias("updated"),
    )


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a document parser might have returned for the dirty documents.

    Some documents have only layout chunks, some only text, some failed.
    """
    doc_id = F.col("doc_id")
    text = dirty(doc_id, F.col("text"))
    lines = F.split("dirty", "\n")
    layout = F.transform(
        lines,
        lambda line, i: F.struct(
            F.concat(F.lit("c"), i).alias("chunk_id"),
            line.alias("content"),
            (i / 4).cast("int").alias("page_start"),
            ((i + 1) / 4).cast("int").alias("page_end"),
            F.array(F.concat(F.lit("b"), i)).alias("source_block_ids"),
        ),
    )
    named = documents(spark, sf_dir).select(
        "doc_id", text.alias("dirty"), file_name(doc_id, F.col("source")).alias("name")
    )
    return named.select(
        "doc_id",
        object_uri(BUCKET, F.col("name")).alias("uri"),
        "name",
        F.when(doc_id % 7 == 0, "").when(doc_id % 7 != 3, F.col("dirty")).alias("text"),
        F.when(doc_id % 7 % 3 == 0, layout).otherwise(F.array()).alias("layout_chunks"),
        F.when(doc_id % 97 == 5, FAILED).alias("error"),
    )


def processed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents count as processed."""
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return files(spark, sf_dir).join(labelled, "doc_id", "left_semi").select("uri")


def notifications(events: DataFrame, listing: DataFrame) -> DataFrame:
    """Storage notifications about the files, made from the events (batch or stream)."""
    event_id = F.col("event_id")
    kind = event_id % 10
    named = events.join(
        listing.select(F.col("doc_id").alias("user_id"), "name"), "user_id"
    )
    body = F.to_json(
        F.struct(
            F.lit("storage#object").alias("kind"),
            "name",
            F.lit(BUCKET).alias("bucket"),
            F.lit("application/pdf").alias("contentType"),
        )
    )
    # Bodies of other kinds: no object, text after the value, a repeated key, and bad UTF-8.
    other = event_id % 100
    text = (
        F.when(other.isin(1, 24), F.lit("[1]"))
        .when(other == 21, F.concat(body, F.lit(" x")))
        .when(other == 14, F.concat(F.lit(REPEATED), F.substr(body, F.lit(2))))
        .otherwise(body)
    )
    raw = text.cast("binary")
    raw = F.when(other == 31, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(raw)
    # Spark breaks Base64 text into lines, a message carries it in one.
    encoded = F.regexp_replace(F.base64(raw), "\r\n", "")
    data = (
        F.when(kind == 5, F.concat(F.lit("A"), encoded))
        .when(kind == 7, F.when(event_id % 20 == 7, ""))
        .otherwise(encoded)
    )
    attributes = F.when(
        kind != 3,
        F.create_map(
            F.lit("bucketId"),
            F.when(kind == 4, "").otherwise(BUCKET),
            F.lit("objectId"),
            F.col("name"),
            F.lit("eventType"),
            F.when(F.col("event_type") == "error", "OBJECT_DELETE").otherwise("OBJECT_FINALIZE"),
        ),
    )
    message = F.struct(data.alias("data"), attributes.alias("attributes"))
    return named.select(
        "event_id",
        F.when(kind != 6, data).alias("data"),
        F.when(kind != 6, attributes).alias("attributes"),
        F.when(kind == 6, message).alias("message"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given embeddings in the shape of the vector table."""
    label = F.col("label").cast("string")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("gs://vectors/label_"), label).alias("source"),
        F.concat(F.lit("label_"), label).alias("filename"),
        F.col("vec_id").cast("int").alias("chunk_index"),
        F.concat(
            F.repeat(F.concat(F.lit("vector "), F.col("vec_id"), F.lit("\n")), 1 + F.col("vec_id").cast("int") % 40),
        ).alias("content"),
        F.lit("{}").alias("metadata"),
        "embedding",
        "label",
    )
