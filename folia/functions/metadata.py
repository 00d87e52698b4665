"""Document metadata as Column expressions over the cleaned text.

Words and lines are counted for Arrow batches of texts: Python's white space and line breaks are those of
``patterns``, and only the ASCII letters and the Kelvin sign become a hint's letters in lower case.
"""

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from folia.functions.arrow import texts
from folia.functions.patterns import DIGIT, WORD, WORD_BEHIND, WS

# Words that hint at English, the share of words they must exceed, and
# the number of words below which no guess is made.
ENGLISH_HINTS = frozenset(("the", "and", "is", "in", "it", "of", "to", "a"))
ENGLISH_SHARE = 0.05
MIN_WORDS = 10
# Fixed value: a table is more than this many lines with a pipe.
PIPE_LINES = 3


def char_count(text: Column) -> Column:
    return F.length(text)


_COUNTS = T.StructType(
    [
        T.StructField("word_count", T.IntegerType()),
        T.StructField("line_count", T.IntegerType()),
        T.StructField("has_tables", T.BooleanType()),
        T.StructField("language", T.StringType()),
    ]
)


def _counts(text: Column) -> Column:
    return F.arrow_udf(_count, _COUNTS)(text)


def _count(column: pa.Array) -> pa.Array:
    rows = []
    for text in texts(column):
        if text is None:
            rows.append((None, None, None, "unknown"))
            continue
        words, lines = text.lower().split(), text.splitlines()
        hits = sum(map(ENGLISH_HINTS.__contains__, words))
        english = len(words) >= MIN_WORDS and hits > len(words) * ENGLISH_SHARE
        tables = text.count("|") > PIPE_LINES and sum("|" in line for line in lines) > PIPE_LINES
        rows.append((len(words), len(lines), tables, "en" if english else "unknown"))
    kinds = [to_arrow_type(field.dataType) for field in _COUNTS]
    values = zip(*rows) if rows else [()] * len(kinds)
    return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], _COUNTS.names)


def word_count(text: Column) -> Column:
    """Words between white space."""
    return _counts(text)["word_count"]


def line_count(text: Column) -> Column:
    """Lines under any line break; a final break opens no further line."""
    return _counts(text)["line_count"]


def has_tables(text: Column) -> Column:
    return _counts(text)["has_tables"]


def has_lists(text: Column) -> Column:
    return text.rlike(rf"(?md)^{WS}*(?:[-*•]|{DIGIT}+[.)]){WS}")


def has_numbers(text: Column) -> Column:
    # As a yes/no test the shortest form of each alternative is enough.
    return text.rlike(
        rf"(?=[$,0-9\p{{Nd}}])"
        rf"(?:\${DIGIT}|[,0-9\p{{Nd}}]{WS}?%|(?<!{WORD_BEHIND}){DIGIT}{{4}}(?!{WORD}))"
    )


def language(text: Column) -> Column:
    """``en`` when enough words are common English ones, else ``unknown``."""
    return _counts(text)["language"]


def or_unknown(name: Column) -> Column:
    """``name``, or ``unknown`` where it is NULL or empty."""
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("unknown"))


def metadata(text: Column, filename: Column) -> Column:
    """The metadata record, stamped with the time of the query.

    The struct is built in one go: adding a field to it later would make the optimizer repeat its
    costly expression for every field.
    """
    counts = _counts(text)
    return F.struct(
        or_unknown(filename).alias("filename"),
        char_count(text).alias("char_count"),
        counts["word_count"].alias("word_count"),
        counts["line_count"].alias("line_count"),
        counts["has_tables"].alias("has_tables"),
        has_lists(text).alias("has_lists"),
        has_numbers(text).alias("has_numbers"),
        F.current_timestamp().alias("extracted_at"),
        counts["language"].alias("language"),
    )
