"""Texts in Arrow batches, and the memory they take."""

import ctypes
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def as_text(texts: pa.Array) -> pa.Array:
    """A plain array of strings with 64-bit offsets and no NULL."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, sizes: np.ndarray, limit: int):
    """Parts of a batch whose rows' sizes sum up to about ``limit``, or single large rows."""
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


@cache
def _trim():
    """The C library's way to give memory back, if it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def release() -> None:
    """Return unused memory of Arrow and of the C library to the system."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def text_slices(batch: pa.RecordBatch, text: str = "text", limit: int = 2 << 20):
    """Parts of a batch holding about ``limit`` bytes of text, or a single long text.

    After a batch, memory that it no longer needs goes back to the system: Python workers stay
    for later tasks and stages, whose memory they would otherwise take.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    yield from slices(batch, sizes, limit)
    release()
