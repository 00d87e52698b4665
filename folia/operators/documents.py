"""From extracted documents to cleaned, chunked and described ones: narrow transformations."""

from pyspark.sql import Column, DataFrame, functions as F

from folia.config import Settings
from folia.functions.cleaning import clean
from folia.functions.metadata import metadata, or_unknown
from folia.functions.naming import basename
from folia.functions.splitting import split_text

NOT_EXTRACTED = "no extracted document"


def extracted_text(text: Column, layout_chunks: Column) -> Column:
    """The text, or the layout chunks joined by blank lines where there is none."""
    contents = F.transform(layout_chunks, lambda chunk: chunk["content"])
    return F.coalesce(
        F.nullif(text, F.lit("")), F.array_join(contents, "\n\n"), F.lit("")
    )


def layout_chunk_rows(extracted: DataFrame) -> DataFrame:
    """One row per layout chunk."""
    exploded = extracted.select(
        "uri", F.posexplode("layout_chunks").alias("position", "chunk")
    )
    return exploded.select("uri", "position", "chunk.*")


def chunk_records(texts: Column, source: Column) -> Column:
    """Chunk texts as records with index, length and source."""
    return F.transform(
        texts,
        lambda text, i: F.struct(
            i.alias("chunk_index"),
            text.alias("content"),
            F.length(text).alias("char_count"),
            or_unknown(source).alias("source"),
        ),
    )


def chunk_rows(
    documents: DataFrame, text: str, source: str, settings: Settings = Settings()
) -> DataFrame:
    """Split the ``text`` column; all other columns stay, one row per chunk."""
    texts = split_text(F.col(text), settings.chunk_size, settings.chunk_overlap)
    kept = [F.col(name) for name in documents.columns if name not in (text, source)]
    exploded = documents.select(
        *kept, F.col(source).alias("_source"), F.posexplode(texts).alias("chunk_index", "content")
    )
    return exploded.select(
        *kept,
        "chunk_index",
        "content",
        F.length("content").alias("char_count"),
        or_unknown(F.col("_source")).alias("source"),
    )


# Both names stand for the same operation.
chunk_rows_with_overlap = chunk_rows


def process(extracted: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Clean, split and describe every document; failed ones keep their ``error``.

    One row per document in, one out. The text is cleaned once: each step is a
    projection of its own, which the optimizer keeps apart because the next one uses
    its costly column several times.
    """
    layout = F.coalesce("layout_chunks", F.array())
    raw = extracted.select(
        F.col("uri").alias("source"),
        "name",
        basename(F.col("uri")).alias("filename"),
        extracted_text(F.col("text"), F.col("layout_chunks")).alias("raw"),
        layout.alias("layout_chunks"),
        "error",
    )
    cleaned = raw.withColumn("cleaned", clean(F.col("raw")))
    texts = split_text(F.col("cleaned"), settings.chunk_size, settings.chunk_overlap)
    described = cleaned.select(
        "source",
        "name",
        "filename",
        F.length("raw").alias("raw_char_count"),
        F.length("cleaned").alias("cleaned_char_count"),
        metadata(F.col("cleaned"), F.col("filename")).alias("metadata"),
        "layout_chunks",
        texts.alias("texts"),
        "error",
    )
    return described.select(
        "source",
        "name",
        "filename",
        "raw_char_count",
        "cleaned_char_count",
        "metadata",
        F.size("layout_chunks").alias("layout_chunk_count"),
        F.size("texts").alias("text_chunk_count"),
        "layout_chunks",
        chunk_records(F.col("texts"), F.col("filename")).alias("text_chunks"),
        "error",
    )


def succeeded(processed: DataFrame) -> DataFrame:
    """Documents without an error: one bad document does not stop the others."""
    return processed.where(F.col("error").isNull())


def summary(processed: DataFrame) -> DataFrame:
    return processed.select(
        "source",
        "raw_char_count",
        "cleaned_char_count",
        "layout_chunk_count",
        "text_chunk_count",
    )
