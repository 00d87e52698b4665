"""A training corpus from raw documents, in five stages.

Each stage takes what the one before kept: documents whose language is told with
confidence, one of each group of similar texts, without long passages that repeat,
without personal data, packed into sequences.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folia.llm import language, packing, pii, setjoin, suffixes
from folia.session import materialise


def confident_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that language identification rejects."""
    told = language.identify(_wrapped(docs), language.train(docs))
    return _unwrapped(told.where(~F.col("lang_rejected")), docs, F.col("text"))


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of similar word shingles."""
    return setjoin.one_of_each(docs).select(*docs.columns)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove bytes covered by a repeated string."""
    return _with_new_text(docs, suffixes.cut_documents(docs))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind."""
    found = pii.find(_wrapped(docs), pii.train(docs), redact=True)
    return _with_new_text(docs, _unwrapped(found, docs, F.col("pii.redacted")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts' ids into sequences of 1024."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _wrapped(docs: DataFrame) -> DataFrame:
    """The texts beside what else their documents hold, so that no names can clash."""
    others = [c for c in docs.columns if c != "text"]
    return docs.select("text", F.struct(*others).alias("document"))


def _unwrapped(wrapped: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The documents again, with this text."""
    columns = [text if c == "text" else F.col("document")[c] for c in docs.columns]
    return wrapped.select(*(value.alias(c) for value, c in zip(columns, docs.columns)))


def _with_new_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of documents, with ``n_chars`` as long as the text is now."""
    columns = [F.col(c) for c in docs.columns if c != "n_chars"]
    length = F.length("text").cast("long").alias("n_chars")
    kept = changed.select(*columns, *([length] if "n_chars" in docs.columns else []))
    return kept.select(*docs.columns)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", confident_language),
    ("similar", one_of_similar),
    ("repeats", unrepeated),
    ("personal", without_personal_data),
    ("pack", packed),
]

# The language model, the merges of the tokenizer and best fit have no SQL; a test compares
# the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
