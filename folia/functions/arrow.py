"""Arrow columns as Python values."""

import pyarrow as pa


def texts(column: pa.Array) -> list[str | None]:
    """The strings of a column; bytes that are no UTF-8 become replacement characters."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if b is None else b.decode(errors="replace") for b in column.cast(pa.binary()).to_pylist()]
