"""Feature-hash embedding of a text as one Column expression.

Stands in for a hosted embedding model with the same contract: a fixed number of
dimensions, one vector per text, equal texts give equal vectors. A word counts in
the dimension its MD5 picks; the counts are scaled to unit length. A text without
words gives the zero vector.

It runs inside the row, so embedding a table needs no shuffle. Words are counted for a whole Arrow batch
at once, and a worker remembers the dimensions of words, as most words come again.
"""

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from folia.functions.arrow import texts
from folia.functions.patterns import WORD

# Characters whose lower case and class are the same in the JVM and in Python, whatever their versions.
_SETTLED = r"\x00-\x{24f}\x{2000}-\x{206f}"
# Words that a worker remembers, and texts that are counted together.
_WORDS, _LONGEST, _TEXTS = 200_000, 40, 512


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"{WORD}+"), F.lit(0))


class _Buckets(dict):
    """Dimension of a token: the first 32 bits of its MD5, modulo ``dims``."""

    def __init__(self, dims: int):
        self._dims = dims

    def __missing__(self, token: str) -> int:
        head = hashlib.md5(token.encode(), usedforsecurity=False).digest()[:4]
        bucket = int.from_bytes(head, "big") % self._dims
        if len(token) <= _LONGEST:
            if len(self) >= _WORDS:
                self.clear()
            self[token] = bucket
        return bucket


def _weights(words: list[list[str]], buckets: _Buckets, dims: int) -> np.ndarray:
    """Unit rows of the counts of each text's words; zeros where there are none."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    found = map(buckets.__getitem__, chain.from_iterable(words))
    places = np.repeat(np.arange(len(words)) * dims, sizes) + np.fromiter(found, np.int64, int(sizes.sum()))
    counts = np.bincount(places, minlength=len(words) * dims).reshape(-1, dims)
    norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return (counts / np.where(norms == 0, 1, norms)).astype(np.float32)


def _embedder(dims: int):
    word = re.compile(r"\w+")

    def embed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        buckets = _Buckets(dims)
        for plain, cut in batches:
            rows = []
            for first in range(0, len(plain), _TEXTS):
                whole, others = texts(plain.slice(first, _TEXTS)), cut.slice(first, _TEXTS).to_pylist()
                words = [o or [] if t is None else word.findall(t.lower()) for t, o in zip(whole, others)]
                rows.append(_weights(words, buckets, dims).ravel())
            values = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.float32))
            missing = plain.is_null().to_numpy(zero_copy_only=False) & cut.is_null().to_numpy(zero_copy_only=False)
            ends = np.arange(len(plain) + 1, dtype=np.int32) * dims
            yield pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array(missing))

    return F.arrow_udf(embed, "array<float>")


def hash_embedding(text: Column, dims: int) -> Column:
    """``array<float>`` of length ``dims``; NULL for NULL."""
    # Other texts are cut into words by the JVM.
    other = (F.octet_length(text) != F.length(text)) & text.rlike(f"[^{_SETTLED}]")
    return _embedder(dims)(F.when(~other, text), F.when(other, tokens(text)))
