"""Byte-pair encoding by an index of pair occurrences, and decoding.

The new distinct words of a batch are laid out as one sequence of symbols. An index maps each
pair that the vocabulary merges to all positions where it occurs, and the active merges
are applied in ascending rank, each one at all of its positions. A merge takes two symbols'
place, so the pairs with their neighbours change: the new pairs' positions are added to their
lists, and positions of pairs that are gone are passed over when their turn comes.
Words do not touch each other, so applying a rank to all of them at once gives what each
of them would get alone.

Texts are cut into words that tokenization never joins (see ``tokenids``); a worker keeps the ids
of the words it has met.
"""

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from folia.llm.frames import with_text
from folia.llm.texts import slices, text_slices
from folia.llm.tokenids import REMEMBERED_WORDS, WordMemory, byte_letters, plain_word

# Bits of a symbol's id in the key of a pair.
_BITS = 24
# Ids that are decoded together.
_DECODED = 500_000


class Merges:
    """The merges of a vocabulary: for the key of a pair, its rank; for a rank, what it makes."""

    def __init__(self, model: dict):
        vocabulary = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocabulary = vocabulary
        self.ranks: dict[int, int] = {}
        self.pairs: list[tuple[int, int, int]] = []
        made: dict[str, int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.pairs.append(pair)
            self.ranks[pair[0] << _BITS | pair[1]] = rank
            made.setdefault(left + right, rank)
        # Then what a merge makes has higher ranks only, and ranks can be applied in turn.
        for rank, (left, right) in enumerate(model["merges"]):
            if made[left + right] != rank or max(made.get(left, -1), made.get(right, -1)) >= rank:
                raise ValueError(f"merge {rank} does not come after all merges of its parts")
        self._keys = np.array(sorted(self.ranks), np.int64)
        self._key_ranks = np.array([self.ranks[k] for k in self._keys.tolist()], np.int64)

    def ids(self, words: list[str]) -> list[list[int]]:
        """The ids of distinct words, spelt in the letters of the vocabulary."""
        known, end = self.vocabulary, self.end
        symbols: list[int] = []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for word in words:
            symbols += [known[letter] for letter in word[:-1]]
            symbols.append(known[word[-1] + end])
        self._merge(symbols, lengths)
        ends = np.cumsum(lengths).tolist()
        starts = [0, *ends[:-1]]
        return [[s for s in symbols[a:b] if s >= 0] for a, b in zip(starts, ends)]

    def _occurrences(self, symbols: list[int], lengths: np.ndarray) -> dict[int, list[int]]:
        """For each rank the positions of its pair."""
        flat = np.array(symbols, np.int64)
        keys = flat[:-1] << _BITS | flat[1:]
        # The last symbol of a word has no pair with the next word.
        keys[np.cumsum(lengths)[:-1] - 1] = -1
        at = np.searchsorted(self._keys, keys)
        at[at == len(self._keys)] = 0
        where = np.flatnonzero(self._keys[at] == keys) if len(self._keys) else np.zeros(0, int)
        ranks = self._key_ranks[at[where]] if len(where) else where
        order = np.argsort(ranks, kind="stable")
        found, firsts = np.unique(ranks[order], return_index=True)
        groups = np.split(where[order], firsts[1:])
        return {rank: group.tolist() for rank, group in zip(found.tolist(), groups)}

    def _merge(self, symbols: list[int], lengths: np.ndarray) -> None:
        """Apply the merges in place; symbols that are merged away become -1."""
        if not symbols:
            return
        occurrences = self._occurrences(symbols, lengths)
        size = len(symbols)
        following = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        ends = np.cumsum(lengths).tolist()
        for end in ends:
            following[end - 1] = -1
            if end < size:
                before[end] = -1
        active = sorted(occurrences)
        rank_of, pairs = self.ranks.get, self.pairs
        while active:
            rank = heapq.heappop(active)
            left, right, whole = pairs[rank]
            # Positions were added in the order of other merges; overlaps go to the first.
            for i in sorted(occurrences.pop(rank)):
                j = following[i]
                if symbols[i] != left or j < 0 or symbols[j] != right:
                    continue
                symbols[i], symbols[j] = whole, -1
                k = following[i] = following[j]
                if k >= 0:
                    before[k] = i
                    new = rank_of(whole << _BITS | symbols[k])
                    if new is not None:
                        if new in occurrences:
                            occurrences[new].append(i)
                        else:
                            occurrences[new] = [i]
                            heapq.heappush(active, new)
                h = before[i]
                if h >= 0:
                    new = rank_of(symbols[h] << _BITS | whole)
                    if new is not None:
                        if new in occurrences:
                            occurrences[new].append(h)
                        else:
                            occurrences[new] = [h]
                            heapq.heappush(active, new)


class PairEncoder(WordMemory):
    """Encodes texts with the file of a vocabulary that drops white space."""

    def __init__(self, path: str):
        super().__init__(spaces=False)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        rules = Tokenizer.from_file(path)
        self._normalizer, self._pre_tokenizer = rules.normalizer, rules.pre_tokenizer
        self._merges = Merges(described["model"])
        self._special = {t["content"]: t["id"] for t in described["added_tokens"]}
        names = sorted(map(re.escape, self._special), key=len, reverse=True)
        self._border = re.compile(f"({'|'.join(names)})") if names else None
        self._letters = byte_letters()
        # The ids of parts: a word is met with capitals and other signs after it again.
        self._known: dict[str | int, list[int]] = {}
        self.names = self._tokens(described)

    def _tokens(self, described: dict) -> pa.Array:
        """The spelling of every id."""
        spelt = {i: token for token, i in described["model"]["vocab"].items()}
        spelt |= {i: name for name, i in self._special.items()}
        return pa.array([spelt.get(i, "") for i in range(max(spelt) + 1)], pa.large_string())

    def _parts(self, word: str) -> list[str | int]:
        """What a word is cut into before merging: spellings, and ids of special tokens."""
        letters = plain_word(word)
        if letters is not None:
            low = (letters[0].lower(), letters[1])
            return [p.encode("utf-8").decode("latin-1").translate(self._letters) for p in low if p]
        parts: list[str | int] = []
        for piece in self._border.split(word) if self._border else [word]:
            if piece in self._special:
                parts.append(self._special[piece])
            elif piece:
                clean = self._normalizer.normalize_str(piece) if self._normalizer else piece
                parts += [p for p, _ in self._pre_tokenizer.pre_tokenize_str(clean)]
        return parts

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        known = self._known
        if len(known) > REMEMBERED_WORDS // 2:
            known.clear()
        cut = [self._parts(self._spelt(word)) for word in words]
        new = list({p: None for parts in cut for p in parts if p not in known and isinstance(p, str)})
        known.update(zip(new, self._merges.ids(new)))
        known.update((i, [i]) for i in self._special.values())
        return [
            known[parts[0]] if len(parts) == 1 else [i for p in parts for i in known[p]]
            for parts in cut
        ]


_ENCODERS: dict[str, PairEncoder] = {}


def _encoder(path: str) -> PairEncoder:
    """The worker's encoder for a file; its words are kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PairEncoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids``, the ids of the whole text in the vocabulary of a file.

    The ids are those of the tokenizers library without special tokens added; a special token
    that a text spells out is that token, as there. A NULL or empty text has no ids, rows
    keep their number whatever their ids are (NULL, repeated), and other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for part in text_slices(batch):
                ids, ends = encoder.encode(part.column("text"))
                listed = pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), listed], ["doc_id", "ids"])

    return with_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The frame with ``decoded``: the tokens of ``ids`` as the file's decoder joins them.

    Only files without a decoder are known here; the library then puts a space between
    tokens. NULL ids give an empty text, unknown ids are an error.
    """
    with open(path, encoding="utf-8") as file:
        if json.load(file)["decoder"] is not None:
            raise ValueError("files with a decoder are not supported")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _encoder(path).names
        for batch in batches:
            numbers = pc.fill_null(pc.list_value_length(batch.column("ids")), 0)
            numbers = numbers.to_numpy(zero_copy_only=False).astype(np.int64)
            done = 0
            for part in slices(batch, numbers, _DECODED):
                ends = np.append(0, np.cumsum(numbers[done : done + part.num_rows]))
                done += part.num_rows
                spelt = names.take(part.column("ids").flatten())
                listed = pa.LargeListArray.from_arrays(pa.array(ends), spelt)
                texts = pc.binary_join(listed, pa.scalar(" ", pa.large_string()))
                yield part.append_column("decoded", texts.cast(pa.string()))

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """Number of ids, and SHA-256 sums of the ids in decimals and of the decoded text."""
    spelt = F.array_join("ids", " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(spelt.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
