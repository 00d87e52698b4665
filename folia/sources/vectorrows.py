"""Chunks as rows of the vector table."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from folia.functions.hashing import hash_embedding
from folia.operators.ids import with_dense_ids
from folia.schemas import VECTORS

# A step that adds the vectors, such as ``embed_with_model`` with its model filled in.
Embed = Callable[[DataFrame], DataFrame]

REQUIRED = ("source", "filename", "chunk_index", "content")


def vector_rows(
    chunks: DataFrame,
    dims: int,
    first_id: int = 1,
    dedupe_against: DataFrame | None = None,
    embed: Embed | None = None,
) -> DataFrame:
    """Chunks as rows of the table, with ids in (source, chunk_index) order.

    ``chunks`` holds source, filename, chunk_index, content, metadata (NULL becomes
    ``{}``) and, if the vectors exist already, embedding; otherwise the content is
    embedded, after the ids are assigned, so vectors are never shuffled. ``embed`` adds
    ``embedding`` to a frame with ``content``; without it, the feature hash is used.
    """
    if dedupe_against is not None:
        stored = dedupe_against.select("source", "chunk_index").distinct()
        chunks = chunks.join(stored, ["source", "chunk_index"], "left_anti")
    numbered = with_dense_ids(chunks, ["source", "chunk_index"], first_id)
    if embed is not None and "embedding" not in chunks.columns:
        numbered = embed(numbered)
    if "embedding" in numbered.columns:
        vector = _checked_size(F.col("embedding").cast("array<float>"), dims)
    else:
        vector = hash_embedding(F.col("content"), dims)
    return numbered.select(
        "id",
        *(_not_null(name) for name in REQUIRED),
        vector.alias("embedding"),
        F.coalesce("metadata", F.lit("{}")).alias("metadata"),
        F.current_timestamp().alias("created_at"),
    )


def _not_null(name: str) -> Column:
    message = F.lit(f"{name} must not be NULL")
    kind = VECTORS[name].dataType
    return F.coalesce(name, F.raise_error(message).cast(kind)).alias(name)


def _checked_size(vector: Column, dims: int) -> Column:
    wrong = F.concat(
        F.lit(f"expected {dims} dimensions, not "), F.size(vector).cast("string")
    )
    checked = F.when(F.size(vector) == dims, vector).otherwise(
        F.raise_error(wrong).cast("array<float>")
    )
    return F.when(vector.isNotNull(), checked)
