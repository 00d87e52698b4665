"""Token ids of many texts, each distinct word encoded once per Python worker.

The vocabularies' own tokenizers split a text into words before they merge anything, and a
single space between two other characters is always such a border. So a text is cut there,
the distinct words of a batch are looked up or encoded, and the ids are put together with
array operations. The ids are those of encoding the whole text.
"""

import gc
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from folia.llm.texts import as_text

# Words remembered per worker; beyond it the less frequent half is forgotten.
REMEMBERED_WORDS = 500_000

# A word of Latin-1 letters, perhaps followed by a run of other signs, is cut between the
# two by every pattern used here; the vocabulary's merges then see exactly these parts.
_PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|*#%&$]*)")
# Marks the first word of a text among the remembered ones; no text can hold this code point.
FIRST = "\ud800"
_BORDER = re.compile(r"(?<=\S)(?= \S)")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte.

    Printable Latin-1 signs stand for themselves, all others for the code points from 256.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def plain_word(word: str) -> tuple[str, str] | None:
    """The letters of a word and the run of other signs after them, if it is so simple."""
    plain = _PLAIN.fullmatch(word)
    return (plain[1], plain[2]) if plain else None


class WordMemory:
    """Puts the ids of texts together from those of their words, which it remembers.

    ``spaces`` says that a space belongs to the word after it; otherwise it is dropped.
    """

    def __init__(self, spaces: bool, shares: int = 1):
        # ``shares`` memories of a worker have the bound in common.
        self._spaces, self._shares = spaces, shares
        self._clear()

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _encode_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and the number of each."""
        found = self._encode_words(words)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, lengths.sum()), lengths

    def _spelt(self, word: str) -> str:
        """What a remembered word stands for: with a space before it, or at a text's start."""
        if word[:1] == FIRST:
            return word[1:]
        return f" {word}" if self._spaces else word

    def _split(self, text: str) -> list[str]:
        """The words, as remembered, of a text with other white space than single spaces."""
        return [
            w[1:] if w[:1] == " " and not self._is_odd(w[1:]) else FIRST + w
            for w in _BORDER.split(text)
        ]

    def _clear(self) -> None:
        self._place: dict[str, int] = {}
        self._starts = np.zeros(1, np.int64)
        self._ids = np.zeros(0, np.uint32)
        self._odd = np.zeros(0, bool)
        self._batches = np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Keep the words that most batches had, so that the memory stays bounded.

        At most half of the memory is kept, and no word of a single batch. Counts are
        halved, so that words which were frequent long ago make room for others.
        """
        seen = self._batches
        kept = np.flatnonzero(seen > 1)
        most = REMEMBERED_WORDS // (2 * self._shares)
        if len(kept) > most:
            order = np.argsort(-seen[kept], kind="stable")
            kept = np.sort(kept[order[:most]])
        words = list(self._place)
        ids = [self._ids[self._starts[k] : self._starts[k + 1]] for k in kept]
        odd = self._odd[kept]
        self._clear()
        self._place = {words[k]: i for i, k in enumerate(kept.tolist())}
        self._starts = np.append(0, np.cumsum([len(i) for i in ids])).astype(np.int64)
        self._ids = np.concatenate([self._ids, *ids])
        self._odd = odd
        self._batches = seen[kept] // 2

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the ids of each word stand."""
        # Many small lists are made and soon gone; the collector would go through all of them.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._found_places(words)
        finally:
            if collecting:
                gc.enable()

    def _found_places(self, words: list[str]) -> np.ndarray:
        place = self._place
        missing = list(dict.fromkeys([w for w in words if w not in place]))
        if missing:
            more, lengths = self._encode_all(missing)
            place.update(zip(missing, range(len(place), len(place) + len(missing))))
            # Most words are letters and signs, which are quickly told.
            odd = [not w.isalnum() and self._is_odd(w) for w in missing]
            self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(lengths)])
            self._ids = np.concatenate([self._ids, more])
            self._odd = np.concatenate([self._odd, odd])
            self._batches = np.concatenate([self._batches, np.zeros(len(missing), np.int32)])
        return np.fromiter(map(place.__getitem__, words), np.int32, len(words))

    def _is_odd(self, word: str) -> bool:
        """Whether white space next to the word makes it unsafe to cut there."""
        if word[:1] == FIRST:
            return len(word) > 1 and word[-1].isspace()
        return not word or word[-1].isspace() or word[0].isspace()

    def _one_by_one(self, text: str, end: list[int]) -> np.ndarray:
        """A text with more than single spaces between its words."""
        places = self._places(self._split(text))
        parts = [self._ids[self._starts[p] : self._starts[p + 1]] for p in places]
        return np.concatenate([*parts, np.array(end, np.uint32)])

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text starts (one more at the end).

        With ``end_id`` every text ends with that id.
        """
        texts = as_text(texts)
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if len(self._place) > REMEMBERED_WORDS // self._shares:
            self._forget()
        if not self._spaces:
            # Where white space is dropped, a line break is as good a border as a space.
            texts = pc.replace_substring(texts, "\n", " ")
        pieces = pc.split_pattern(texts, " ")
        borders = pieces.offsets.to_numpy().astype(np.int64)
        words = pieces.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        indices = words.indices.to_numpy()
        own = self._places(distinct)
        self._batches[own] += 1
        places = own[indices]
        odd = np.zeros(len(texts), bool)
        if self._spaces:
            # The first word of a text has no space before it.
            places[borders[:-1]] = self._places([FIRST + distinct[i] for i in indices[borders[:-1]]])
            unsafe = self._odd[places]
            if unsafe.any():
                odd = np.logical_or.reduceat(unsafe, borders[:-1])
        lengths = np.diff(self._starts).astype(np.int32)[places]
        starts = self._starts[places]
        if odd.any():
            lengths[np.repeat(odd, np.diff(borders))] = 0
        ids = self._ids
        if end_id is not None:
            # One more word at the end of each text.
            starts = np.insert(starts, borders[1:], len(ids))
            lengths = np.insert(lengths, borders[1:], np.where(odd, 0, 1))
            ids = np.append(ids, np.uint32(end_id))
            borders = borders + np.arange(len(borders))
        ends = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        at = np.repeat((starts - ends[:-1]).astype(np.int32), lengths)
        at += np.arange(ends[-1], dtype=np.int32)
        ids, ends = ids[at], ends[borders]
        if odd.any():
            end = [] if end_id is None else [end_id]
            parts = np.split(ids, ends[1:-1])
            for i in np.flatnonzero(odd):
                parts[i] = self._one_by_one(texts[int(i)].as_py(), end)
            ids = np.concatenate(parts)
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, ends


class WordEncoder(WordMemory):
    """Encodes texts with a tokenizers file.

    With ``spaces`` it is a byte-level one; without, letters are lower-cased. Words are mostly
    letters with a few signs after them; these parts are remembered too, as they recur in more
    words, and the vocabulary's merges see each of them once.
    """

    def __init__(self, path: str, spaces: bool):
        super().__init__(spaces)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        # Names of special tokens in a text are ordinary text.
        self._tokenizer.encode_special_tokens = True
        self._model = self._tokenizer.model
        self._table = byte_letters()
        self._clear_parts()

    def _clear_parts(self) -> None:
        # No signs are no ids.
        self._parts: dict[str, int] = {"": 0}
        self._part_starts = np.zeros(2, np.int64)
        self._part_ids = np.zeros(0, np.uint32)

    def _part_places(self, texts: list[str]) -> np.ndarray:
        """Which remembered part each text is; the vocabulary's pattern does not cut them."""
        known = self._parts
        new = list(dict.fromkeys([t for t in texts if t not in known]))
        if new:
            # Parts hold no line break.
            mapped = "\n".join(new).encode("utf-8").decode("latin-1").translate(self._table)
            tokenize = self._model.tokenize
            found = [[t.id for t in tokenize(x)] for x in mapped.split(self._table[10])]
            known.update(zip(new, range(len(known), len(known) + len(new))))
            ends = self._part_starts[-1] + np.cumsum([len(ids) for ids in found])
            self._part_starts = np.concatenate([self._part_starts, ends])
            more = np.fromiter(chain.from_iterable(found), np.uint32)
            self._part_ids = np.concatenate([self._part_ids, more])
        return np.fromiter(map(known.__getitem__, texts), np.int64, len(texts))

    def _encode_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self._parts) > REMEMBERED_WORDS // 2:
            self._clear_parts()
        spelt = list(map(self._spelt, words))
        plain = list(map(_PLAIN.fullmatch, spelt))
        simple = [i for i, match in enumerate(plain) if match]
        letters = [plain[i][1] for i in simple]
        if not self._spaces:
            letters = [text.lower() for text in letters]
        # Two parts of each word; a word that is not so simple is one part of its own.
        parts = np.zeros((len(words), 2), np.int64)
        parts[simple, 0] = self._part_places(letters)
        parts[simple, 1] = self._part_places([plain[i][2] for i in simple])
        others = [i for i, match in enumerate(plain) if not match]
        texts = [spelt[i] for i in others]
        alone = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        parts[others, 0] = len(self._parts) + np.arange(len(others))
        starts = np.concatenate([self._part_starts, self._part_starts[-1] + np.cumsum([len(x) for x in alone], dtype=np.int64)])
        ids = np.concatenate([self._part_ids, np.fromiter(chain.from_iterable(alone), np.uint32)])
        flat = parts.reshape(-1)
        lengths = np.diff(starts)[flat]
        ends = np.cumsum(lengths)
        at = np.repeat(starts[flat] - ends + lengths, lengths) + np.arange(lengths.sum())
        return ids[at], lengths.reshape(-1, 2).sum(axis=1)


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def encoder(path: str, spaces: bool) -> WordEncoder:
    """The worker's encoder for a file; its words are kept from task to task."""
    key = (path, spaces)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, spaces)
    return _ENCODERS[key]
