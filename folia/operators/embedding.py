"""One vector per chunk, by feature hashing or by a model of the user's."""

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from folia.functions.hashing import hash_embedding


def embed_texts(frame: DataFrame, text: str, dims: int, output: str = "embedding") -> DataFrame:
    return frame.withColumn(output, hash_embedding(F.col(text), dims))


def embed_query(spark: SparkSession, text: str, dims: int) -> list[float]:
    """The vector of one text, the same as :func:`embed_texts` gives it."""
    return spark.range(1).select(hash_embedding(F.lit(text), dims)).first()[0]


def embed_with_model(
    frame: DataFrame,
    text: str,
    load_model: Callable[[], Callable[[list[str]], list]],
    output: str = "embedding",
) -> DataFrame:
    """Embed with a model: ``load_model()`` runs once per partition, in the task.

    It returns a function from a list of texts to a list of vectors, which is called
    once per Arrow batch.
    """

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            model = model or load_model()
            vectors = model(batch[text].tolist())
            if len(vectors) != len(batch):
                raise ValueError("the model returned another number of vectors than texts")
            yield batch.assign(**{output: list(vectors)})

    schema = T.StructType(
        [*frame.schema.fields, T.StructField(output, T.ArrayType(T.FloatType()))]
    )
    return frame.mapInPandas(embed, schema)


def embed_or_fail(
    frame: DataFrame,
    text: str,
    load_model: Callable[[], Callable[[list[str]], list]],
    output: str = "embedding",
    error: str = "error",
    batch: int = 256,
) -> DataFrame:
    """Like :func:`embed_with_model`, but a text the model fails on does not stop the others.

    A call that raises, or returns another number of vectors than texts, is repeated with each
    half of its texts, until the guilty text stands alone: it gets no vector, and the message
    in ``error``. So one bad text in a call of ``n`` costs about ``2 log2(n)`` more calls. A model that
    cannot be loaded fails the task. A column of either name in ``frame`` is an error.
    """
    clash = {output, error} & set(frame.columns)
    if clash:
        raise ValueError(f"the frame has a column {sorted(clash)[0]} already")

    def attempt(model: Callable[[list[str]], list], texts: list[str]) -> list[tuple]:
        try:
            vectors = list(model(texts))
            if len(vectors) != len(texts):
                raise ValueError("the model returned another number of vectors than texts")
            return [([float(x) for x in v], None) for v in vectors]
        except Exception as failure:  # whatever a model raises belongs to its texts
            if len(texts) == 1:
                return [(None, str(failure) or type(failure).__name__)]
        half = len(texts) // 2
        return attempt(model, texts[:half]) + attempt(model, texts[half:])

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for rows in batches:
            model = model or load_model()
            for first in range(0, rows.num_rows, batch):
                part = rows.slice(first, batch)
                vectors, messages = zip(*attempt(model, part.column(text).to_pylist()))
                part = part.append_column(output, pa.array(vectors, pa.list_(pa.float32())))
                yield part.append_column(error, pa.array(messages, pa.string()))

    more = [T.StructField(output, T.ArrayType(T.FloatType())), T.StructField(error, T.StringType())]
    return frame.mapInArrow(embed, T.StructType([*frame.schema.fields, *more]))


def failed_documents(chunks: DataFrame) -> DataFrame:
    """``source`` and the ``error`` of its first failed chunk, for documents with one."""
    failed = chunks.where(F.col("error").isNotNull())
    return failed.groupBy("source").agg(F.min_by("error", "chunk_index").alias("error"))


def without_failed(chunks: DataFrame, failed: DataFrame) -> DataFrame:
    """The chunks of documents none of whose chunks has failed."""
    return chunks.join(failed.select("source"), "source", "left_anti").drop("error")


def zip_embeddings(documents: DataFrame, chunks: str, embeddings: str) -> DataFrame:
    """Pair each document's chunks and vectors by position, one row per pair.

    A chunk without an index takes its position. Unequal numbers are an error.
    """
    paired = documents.withColumn("_pairs", _pairs(F.col(chunks), F.col(embeddings)))
    kept = [name for name in documents.columns if name not in (chunks, embeddings)]
    exploded = paired.select(*kept, F.posexplode("_pairs").alias("_position", "_pair"))
    return exploded.select(
        *kept,
        F.coalesce("_pair.chunk.chunk_index", "_position").alias("chunk_index"),
        "_pair.chunk.content",
        "_pair.embedding",
    )


def _pairs(chunks: Column, embeddings: Column) -> Column:
    paired = F.zip_with(
        chunks, embeddings, lambda c, e: F.struct(c.alias("chunk"), e.alias("embedding"))
    )
    return F.when(F.size(chunks) == F.size(embeddings), paired).otherwise(
        F.raise_error(F.lit("chunks and embeddings must have the same length"))
    )
