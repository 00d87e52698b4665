"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A word starts as its characters. An agenda holds the candidate merges of neighbours, the
best-scored first and of equal ones the leftmost; each candidate may be skipped, as a hash
of the seed, the document, the word's position in it, the place and the merged piece tells.
So every occurrence of a word is cut for itself. What is remembered of a word are the merges
its agenda takes when none is skipped, and the cut they give. Candidates that are never taken
change nothing when they are skipped: an occurrence that skips none of these merges has this
cut, and any other one has an agenda of its own. A document is told by a hash of its id and
text. Characters without a piece become byte pieces.

Short words of a batch share one agenda step at a time as columns of arrays; long ones have a
heap each. Both take the same merges.
"""

import heapq
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from folia.llm.frames import with_text
from folia.llm.texts import as_text, text_slices
from folia.llm.tokenids import FIRST, REMEMBERED_WORDS, WordMemory

_U = np.uint64
# The sign that stands for a space in pieces.
SPACE = "▁"
# Longer words get an agenda of their own.
_SHORT = 32
# Words whose agendas go side by side.
_ABREAST = 8_192
# A candidate is one number: rank, row of the left symbol, merged piece; beyond all, none.
_RANK_BITS, _ROW_BITS = 40, 32
_NONE = 1 << 62
# Before and after a word, and where a symbol is merged away. Both merge with nothing.
_EDGE, _GONE = 1 << 30, (1 << 30) + 1
# Merges are remembered as place and piece. Long words have an agenda at each occurrence.
_PIECE_BITS = 27
_ALONE = 0xFFFFFFFF
# Merges looked at in one go; an eighth as many words are cut in one go.
_AT_ONCE = 1_000_000


@dataclass(frozen=True)
class Dropout:
    rate: float = 0.1
    seed: int = 42


class Vocabulary:
    """Pieces, their merges and their bytes."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(pieces) if model.is_byte(i)}
        if len(self.byte_ids) < 256:
            raise ValueError("the vocabulary has no pieces for all bytes")
        scores = np.array([model.get_score(i) for i in range(size)])
        # Equal scores, equal rank: the leftmost merge goes first.
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.symbols = size
        lefts, rights, made = [], [], []
        for piece, own in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    lefts.append(left)
                    rights.append(right)
                    made.append(own)
        left, right, piece = (np.array(x, np.int64) for x in (lefts, rights, made))
        self.pairs = dict(zip((left * size + right).tolist(), made))
        self._fill(left << 32 | right, self.rank[piece] << _RANK_BITS | piece)
        # The symbol of each code point.
        self.symbol_of = np.arange(size, size + sys.maxunicode + 1)
        for char in [" ", *(p for p in self.ids if len(p) == 1)]:
            self.symbol_of[ord(char)] = self.symbol(char)
        values = [b"" if s else p.replace(SPACE, " ").encode() for p, s in zip(pieces, special)]
        for byte, own in self.byte_ids.items():
            values[own] = bytes([byte])
        self.lengths = np.array([len(v) for v in values])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(values), np.uint8)

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """A hash table of all merges; what meets a full slot takes the next free one."""
        bits = len(keys).bit_length() + 2
        self._shift = _U(64 - bits)
        self._slots = np.full((1 << bits) + len(keys) + 1, -1, np.int64)
        self._merges = np.full(len(self._slots), _NONE, np.int64)
        slots = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self._slots[slots] < 0)
            first = free[np.unique(slots[free], return_index=True)[1]]
            self._slots[slots[first]], self._merges[slots[first]] = keys[first], values[first]
            keys, values, slots = (np.delete(x, first) for x in (keys, values, slots + 1))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(_U) * _U(0x9E3779B97F4A7C15) >> self._shift).view(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The candidates that each two symbols make, without a row, or ``_NONE``."""
        keys = left << 32 | right
        slots = self._slot(keys)
        there = self._slots.take(slots)
        found = np.where(there == keys, self._merges.take(slots), _NONE)
        on = np.flatnonzero((there != keys) & (there >= 0))
        while len(on):
            slots[on] += 1
            there = self._slots.take(slots[on])
            hit = there == keys[on]
            found[on[hit]] = self._merges.take(slots[on[hit]])
            on = on[~hit & (there >= 0)]
        return found

    def symbol(self, char: str) -> int:
        """The piece of a character; without one, a number beyond all pieces."""
        # The sign for a space would come back as a space, so its bytes are taken.
        if char == SPACE:
            return self.symbols + ord(char)
        return self.ids.get(SPACE if char == " " else char, self.symbols + ord(char))

    def spelt(self, symbols: list[int]) -> list[int]:
        """Ids of symbols, those beyond all pieces as bytes."""
        if max(symbols, default=0) < self.symbols:
            return symbols
        out: list[int] = []
        for s in symbols:
            if s < self.symbols:
                out.append(s)
            else:
                raw = chr(s - self.symbols).encode("utf-8", "surrogatepass")
                out += [self.byte_ids[b] for b in raw]
        return out

    def spelt_rows(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words one after the other, with the number of symbols of each."""
        beyond = np.flatnonzero(symbols >= self.symbols)
        if not len(beyond):
            return symbols, counts
        chars, of_char = np.unique(symbols[beyond], return_inverse=True)
        raw = [self.spelt([c]) for c in chars.tolist()]
        sizes = np.array([len(r) for r in raw])
        starts, lengths = np.arange(len(symbols)), np.ones(len(symbols), np.int64)
        starts[beyond] = len(symbols) + (np.cumsum(sizes) - sizes)[of_char]
        lengths[beyond] = sizes[of_char]
        ends = np.append(0, np.cumsum(lengths))
        ids = np.concatenate([symbols, *raw])[_spans(starts, lengths)]
        return ids, np.diff(ends[np.append(0, np.cumsum(counts))])

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, the leading space of each text included."""
        return self.bytes[_spans(self.starts[ids], self.lengths[ids])]


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The worker's vocabulary of a file."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all spans, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class PieceEncoder(WordMemory):
    """Cuts words into pieces for one seed.

    ``key`` stands for the document where no keys of documents are given.
    """

    def __init__(self, path: str, dropout: Dropout, key: int = 0):
        super().__init__(spaces=True)
        self.vocabulary = vocabulary(path)
        self._limit = _U(min(int(dropout.rate * 2.0**64), 2**64 - 1))
        self._drops = dropout.rate > 0
        self._seed = _mixed(np.array([dropout.seed], np.int64).view(_U) + _U(1))[0]
        self._key = self._text_keys(np.array([key], np.int64))[0]

    def _text_keys(self, keys: np.ndarray) -> np.ndarray:
        return _mixed(self._seed + keys.astype(np.int64).view(_U))

    # A text starts as if a space stood before it.
    def _spelt(self, word: str) -> str:
        first = word[:1] == FIRST
        own = word[1:] if first else word
        return f" {own}" if own or not first else ""

    def _is_odd(self, word: str) -> bool:
        return word == FIRST or super()._is_odd(word)

    def _split(self, text: str) -> list[str]:
        # Runs of spaces stay together; each word has lost the space that _spelt gives it.
        return [w[1:] for w in re.split(r"(?<=[^ ])(?= )", f" {text}")] if text else []

    def skipped(self, own: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether the candidates are left out: keys of the words, places and merged pieces."""
        if not self._drops:
            return np.zeros(len(piece), bool)
        mixed = own + place.astype(_U) * _U(0x9E3779B97F4A7C15)
        return _mixed(mixed ^ (piece.astype(_U) * _U(0xD6E8FEB86659FD93))) < self._limit

    def _symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words one after the other, and the number of each."""
        raw = "".join(words).encode("utf-32-le", "surrogatepass")
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return self.vocabulary.symbol_of[np.frombuffer(raw, "<u4")], lengths

    def _encode_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What is remembered of words.

        With dropout these are the numbers of merges (or ``_ALONE``) and of symbols, the merges
        taken when none is skipped, the symbols, and the ids that the merges give.
        """
        symbols, counts = self._symbols(list(map(self._spelt, words)))
        if not self._drops:
            ids, lengths = self._cut(symbols, counts, np.full(len(words), self._key))
            return ids.astype(np.uint32), lengths
        short = counts <= _SHORT
        spans = _spans((np.cumsum(counts) - counts)[short], counts[short])
        kept, left, taken, steps = self.by_columns(symbols[spans], counts[short])
        kept, left = self.vocabulary.spelt_rows(kept, left)
        merges, ids = np.zeros((2, len(words)), np.int64)
        merges[short], ids[short] = steps, left
        lengths = 2 + merges + counts + ids
        heads = np.cumsum(lengths) - lengths
        found = np.empty(lengths.sum(), np.uint32)
        found[heads] = np.where(short, merges, _ALONE)
        found[heads + 1] = counts
        found[_spans(heads + 2, merges)] = taken
        found[_spans(heads + 2 + merges, counts)] = symbols
        found[_spans(heads + 2 + merges + counts, ids)] = kept
        return found, lengths

    def _cut(self, symbols: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of symbols, each with its key, and the number of each."""
        starts = np.cumsum(counts) - counts
        short, apart = counts <= _SHORT, np.flatnonzero(counts > _SHORT)
        spans = _spans(starts[short], counts[short])
        kept, left, _, _ = self.by_columns(symbols[spans], counts[short], keys[short])
        kept, left = self.vocabulary.spelt_rows(kept, left)
        if not len(apart):
            return kept, left
        long = [self.by_heap(symbols[starts[i] : starts[i] + counts[i]].tolist(), keys[i]) for i in apart]
        lengths, begin = np.zeros((2, len(counts)), np.int64)
        lengths[short], lengths[apart] = left, [len(ids) for ids in long]
        begin[short], begin[apart] = np.cumsum(left) - left, len(kept) + np.cumsum(lengths[apart]) - lengths[apart]
        return np.concatenate([kept, *long])[_spans(begin, lengths)], lengths

    def _placed(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The remembered place of each word of texts, and where each text starts."""
        pieces = pc.split_pattern(texts, " ")
        borders = pieces.offsets.to_numpy().astype(np.int64)
        words = pieces.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        indices = words.indices.to_numpy()
        own = self._places(distinct)
        self._batches[own] += 1
        places = own[indices]
        places[borders[:-1]] = self._places([FIRST + distinct[i] for i in indices[borders[:-1]]])
        unsafe = self._odd[places]
        if unsafe.any():
            parts = np.split(places, borders[1:-1])
            for i in np.flatnonzero(np.logical_or.reduceat(unsafe, borders[:-1])):
                parts[i] = self._places(self._split(texts[int(i)].as_py()))
            places = np.concatenate(parts)
            borders = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)
        return places, borders

    def _skipping(self, starts: np.ndarray, merges: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Whether each word skips some of its remembered merges, which start there."""
        ends = np.cumsum(merges)
        found = np.zeros(len(merges), bool)
        low = 0
        while low < len(merges):
            base = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, base + _AT_ONCE, side="right")))
            codes = self._ids[_spans(starts[low:high], merges[low:high])]
            own = np.repeat(np.arange(low, high), merges[low:high])
            piece = codes & np.uint32((1 << _PIECE_BITS) - 1)
            found[own[self.skipped(keys[own], codes >> np.uint32(_PIECE_BITS), piece)]] = True
            low = high
        return found

    def encode(self, texts: pa.Array, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text starts (one more at the end).

        ``keys`` tell the documents apart; each word is cut by its document and position.
        """
        if not self._drops:
            return super().encode(texts)
        texts = as_text(texts)
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if len(self._place) > REMEMBERED_WORDS:
            self._forget()
        places, borders = self._placed(texts)
        of_text = np.full(len(texts), self._key) if keys is None else self._text_keys(keys)
        counts = np.diff(borders)
        position = np.arange(len(places)) - np.repeat(borders[:-1], counts)
        own = _mixed(np.repeat(of_text, counts) + position.astype(_U) * _U(0xA24BAED4963EE407))
        heads = self._starts[places]
        merges, symbols = (self._ids[heads + i].astype(np.int64) for i in (0, 1))
        alone = merges == _ALONE
        merges[alone] = 0
        starts = heads + 2 + merges + symbols
        lengths = self._starts[places + 1] - starts
        again = np.flatnonzero(alone | self._skipping(heads + 2, merges, own))
        source, end = [self._ids], len(self._ids)
        for low in range(0, len(again), _AT_ONCE // 8):
            part = again[low : low + _AT_ONCE // 8]
            spans = _spans(starts[part] - symbols[part], symbols[part])
            ids, cut = self._cut(self._ids[spans].astype(np.int64), symbols[part], own[part])
            source.append(ids.astype(np.uint32))
            starts[part], lengths[part] = end + np.cumsum(cut) - cut, cut
            end += len(ids)
        ends = np.append(0, np.cumsum(lengths))
        return np.concatenate(source)[_spans(starts, lengths)], ends[borders]

    def by_rows(self, words: list[list[int]], keys: np.ndarray | None = None) -> list[list[int]]:
        """The ids of words given as lists of symbols."""
        counts = np.array([len(w) for w in words], np.int64)
        symbols = np.array([s for word in words for s in word], np.int64)
        ids, lengths = self._cut(symbols, counts, np.full(len(words), self._key) if keys is None else keys)
        flat, ends = ids.tolist(), np.cumsum(lengths).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def by_columns(
        self, symbols: np.ndarray, counts: np.ndarray, keys: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The symbols left of short words, and the number of each.

        Without keys nothing is skipped, and the merges taken and their numbers follow.
        """
        starts = np.cumsum(counts) - counts
        order = np.argsort(counts, kind="stable")
        parts = []
        for low in range(0, len(order), _ABREAST):
            own = order[low : low + _ABREAST]
            spans = _spans(starts[own], counts[own])
            parts.append(self._abreast(symbols[spans], counts[own], None if keys is None else keys[own]))
        none = np.zeros(0, np.int64)
        kept, left, taken, steps = (np.concatenate([none, *x]) for x in (zip(*parts) if parts else [()] * 4))
        back = np.argsort(order)
        kept = kept[_spans((np.cumsum(left) - left)[back], left[back])]
        taken = taken[_spans((np.cumsum(steps) - steps)[back], steps[back])]
        return kept, left[back], taken, steps[back]

    def _abreast(self, symbols, counts, keys) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words side by side, a column each: every step takes the best merge of each word."""
        n, rows = len(counts), int(counts.max()) + 2
        columns = np.repeat(np.arange(n), counts)
        symbol = np.full(rows * n, _EDGE, np.int64)
        symbol[_spans(np.ones(n, np.int64), counts) * n + columns] = symbols
        after, before = np.arange(n, rows * n + n), np.arange(-n, rows * n - n)
        # By the place of the left symbol.
        agenda = np.full((rows, n), _NONE, np.int64)
        candidates = agenda.reshape(-1)

        def propose(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            found, row = self.vocabulary.merged(left, right), at // n
            if keys is not None:
                good = np.flatnonzero(found < _NONE)
                own = keys[at[good] - row[good] * n]
                piece = found[good] & ((1 << _ROW_BITS) - 1)
                found[good[self.skipped(own, row[good] - 1, piece)]] = _NONE
            candidates[at] = found | row << _ROW_BITS

        grid = np.arange(n, rows * n - n)
        propose(grid, symbol[grid], symbol[grid + n])
        steps = []
        while True:
            best = agenda.min(axis=0)
            active = np.flatnonzero(best < _NONE)
            if not len(active):
                break
            best = best[active]
            row, made = best >> _ROW_BITS & ((1 << _RANK_BITS - _ROW_BITS) - 1), best & ((1 << _ROW_BITS) - 1)
            at = row * n + active
            gone = after[at]
            following, previous = after[gone], before[at]
            symbol[at], symbol[gone], candidates[gone] = made, _GONE, _NONE
            after[at], before[following] = following, at
            propose(
                np.concatenate([previous, at]),
                np.concatenate([symbol[previous], made]),
                np.concatenate([made, symbol[following]]),
            )
            if keys is None:
                steps.append(np.full(n, -1))
                steps[-1][active] = (row - 1) << _PIECE_BITS | made
        cells = symbol.reshape(rows, n).T
        kept = cells < _EDGE
        taken = np.stack(steps, axis=1) if steps else np.zeros((n, 0), np.int64)
        there = taken >= 0
        return cells[kept], kept.sum(axis=1), taken[there], there.sum(axis=1)

    def by_heap(self, word: list[int], key: np.uint64 | None = None) -> list[int]:
        """One word of any length."""
        vocabulary, n = self.vocabulary, len(word)
        symbols, after, before = list(word), list(range(1, n + 1)), list(range(-1, n - 1))
        own = np.array([self._key if key is None else key], _U)
        agenda: list[tuple[int, int, int, int]] = []

        def propose(left: int) -> None:
            right = after[left] if left >= 0 else n
            if right >= n or symbols[left] >= vocabulary.symbols or symbols[right] >= vocabulary.symbols:
                return
            made = vocabulary.pairs.get(symbols[left] * vocabulary.symbols + symbols[right])
            if made is not None:
                heapq.heappush(agenda, (int(vocabulary.rank[made]), left, made, right))

        for place in range(n - 1):
            propose(place)
        while agenda:
            _, left, made, right = heapq.heappop(agenda)
            # Neighbours that have changed since are no candidate any more.
            if symbols[left] < 0 or after[left] != right or symbols[right] < 0:
                continue
            if vocabulary.pairs.get(symbols[left] * vocabulary.symbols + symbols[right]) != made:
                continue
            if self.skipped(own, np.array([left]), np.array([made]))[0]:
                continue
            symbols[left], symbols[right] = made, -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            propose(left)
            propose(before[left])
        return vocabulary.spelt([s for s in symbols if s >= 0])


_ENCODERS: dict[tuple, PieceEncoder] = {}


def piece_encoder(path: str, dropout: Dropout) -> PieceEncoder:
    """The worker's encoder; what it remembers is kept from task to task."""
    key = (path, dropout)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, dropout)
    return _ENCODERS[key]


def decode(path: str, ids) -> str:
    """The text that was encoded."""
    raw = vocabulary(path).decoded(np.asarray(ids, np.int64)).tobytes()
    return raw[1:].decode("utf-8", "surrogatepass")


def encode_pieces(
    docs: DataFrame, model_path: str, dropout: Dropout = Dropout(), keep_ids: bool = False
) -> DataFrame:
    """Cut documents into pieces and decode them again.

    Returns ``doc_id, variant, n_tokens, ids_crc32, lossless`` and, if wanted, ``ids``;
    ``variant`` is the document's own key, a hash of its id and text, by which its words are cut;
    ``lossless`` tells whether the ids' bytes are those of the text. NULL and empty texts
    have no ids; repeated rows get equal ids; a NULL id is hashed like others; an empty
    table gives no rows; other columns are left out.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, limit=4 << 20):
                yield _encoded(rows, model_path, dropout, keep_ids)

    rows = with_text(docs).withColumn("variant", F.xxhash64("doc_id", "text", F.lit(dropout.seed)))
    schema = "doc_id bigint, variant bigint, n_tokens bigint, ids_crc32 bigint, lossless boolean"
    return rows.mapInArrow(encoded, schema + (", ids array<int>" if keep_ids else ""))


def _encoded(rows: pa.RecordBatch, path: str, dropout: Dropout, keep_ids: bool) -> pa.RecordBatch:
    texts = as_text(rows.column("text"))
    encoder = piece_encoder(path, dropout)
    ids, ends = encoder.encode(texts, rows.column("variant").to_numpy())
    sums = np.zeros(len(texts), np.int64)
    lossless, kept = np.zeros(len(texts), bool), [None] * len(texts)
    raw = ids.astype("<u4").view(np.uint8)
    decoded = encoder.vocabulary.decoded(ids)
    byte_ends = np.append(0, np.cumsum(encoder.vocabulary.lengths[ids]))[ends]
    for i, text in enumerate(texts):
        a, b = int(ends[i]), int(ends[i + 1])
        sums[i] = crc32(raw[4 * a : 4 * b])
        # Without the space before the text.
        found = decoded[byte_ends[i] + 1 : byte_ends[i + 1]].tobytes()
        lossless[i] = found == bytes(text.as_buffer() or b"")
        if keep_ids:
            kept[i] = ids[a:b].astype(np.int32)
    columns = {
        "doc_id": rows.column("doc_id"),
        "variant": rows.column("variant"),
        "n_tokens": pa.array(np.diff(ends)),
        "ids_crc32": pa.array(sums),
        "lossless": pa.array(lossless),
    }
    if keep_ids:
        columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
    return pa.RecordBatch.from_pydict(columns)
