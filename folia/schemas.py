"""Explicit schemas; nothing is inferred."""

from pyspark.sql import types as T

_string, _int, _long, _bool = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _record(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


# One object of a listing.
LISTING = _record(
    ("uri", _string), ("name", _string), ("size", _long), ("updated", T.TimestampType())
)

# A chunk proposed by the document parser from the page layout.
LAYOUT_CHUNK = _record(
    ("chunk_id", _string),
    ("content", _string),
    ("page_start", _int),
    ("page_end", _int),
    ("source_block_ids", T.ArrayType(_string)),
)

# What the document parser returned for one object; ``error`` is set where it failed.
EXTRACTED = _record(
    ("uri", _string),
    ("name", _string),
    ("text", _string),
    ("layout_chunks", T.ArrayType(LAYOUT_CHUNK)),
    ("error", _string),
)

TEXT_CHUNK = _record(
    ("chunk_index", _int), ("content", _string), ("char_count", _int), ("source", _string)
)

METADATA = _record(
    ("filename", _string),
    ("char_count", _int),
    ("word_count", _int),
    ("line_count", _int),
    ("has_tables", _bool),
    ("has_lists", _bool),
    ("has_numbers", _bool),
    ("extracted_at", _string),
    ("language", _string),
)

# The stored vectors.
VECTORS = _record(
    ("id", _long),
    ("source", _string),
    ("filename", _string),
    ("chunk_index", _int),
    ("content", _string),
    ("embedding", T.ArrayType(T.FloatType())),
    ("metadata", _string),
    ("created_at", T.TimestampType()),
)

PROCESSED = _record(("uri", _string))

# A storage notification: bare, or wrapped in ``message``.
_MESSAGE = _record(
    ("data", _string), ("attributes", T.MapType(_string, _string))
)
NOTIFICATION = T.StructType([*_MESSAGE.fields, T.StructField("message", _MESSAGE)])
