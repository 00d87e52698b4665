"""Packing, token files and pieces against whole-text encoding."""

from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from folia.llm import packing, pieces, tokenfiles, tokenids

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " a", "a ", "a  b", "x \n y  ", " ", "it's I'LL we've 's", "a\x1cb \x1c c", "\x1ea b",
    "<|endoftext|> a <|endoftext|>", "naïve é́ ΑΣ. Straße ŒUVRE", "foo.Bar, BAZ!! (x)",
    "▁ a▁b", "中文字符没有空格" * 20, "x" * 200 + " 12345", "tab\tand space 　 wide",
]


def plain_ids(path, texts):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def checksum(ids):
    return crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize(("path", "spaces"), [(BYTES, True), (WORDS, False)])
def test_words_give_the_ids_of_whole_texts(path, spaces, words, monkeypatch):
    monkeypatch.setattr(tokenids, "REMEMBERED_WORDS", 50)
    texts = ODD + [words(50, seed) for seed in range(20)]
    encoder = tokenids.WordEncoder(path, spaces)
    for _ in range(3):
        ids, ends = encoder.encode(pa.array(texts), end_id=2)
        found = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
        assert found == [x + [2] for x in plain_ids(path, texts)]
    assert encoder.encode(pa.array([], pa.string()))[1].tolist() == [0]


def texts_of(awkward):
    return [(r["doc_id"], r["text"] or "") for r in awkward.collect()]


@pytest.mark.parametrize("limits", [{}, {"documents": 3, "attention": 300_000, "rule": "dot"}])
def test_packing(awkward, plain, limits):
    capacities = packing.Capacities(tokens=1024, **limits)
    found = plain(packing.pack(awkward, BYTES, 2, capacities, keep_ids=True))
    longest = capacities.piece_tokens()
    rows = texts_of(awkward)
    expected = Counter()
    for (doc_id, _), ids in zip(rows, plain_ids(BYTES, [t for _, t in rows])):
        ids, start = ids + [2], 0
        first = len(ids) % longest or longest
        for n in [first] + [longest] * ((len(ids) - first) // longest):
            expected[doc_id, start, checksum(ids[start : start + n])] += 1
            start += n
    assert Counter(zip(found.doc_id, found.start, found.ids_crc32)) == expected
    assert all(checksum(r.ids) == r.ids_crc32 and len(r.ids) == r.length for r in found.itertuples())
    limits_of_bin = capacities.limits()
    for _, own in found.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert (own.offset == own.length.cumsum() - own.length).all()
        assert (np.array([own.length.sum(), len(own), (own.length**2).sum()]) <= limits_of_bin).all()


def test_packing_uses_few_bins():
    random = np.random.default_rng(0)
    lengths = Counter(random.integers(1, 1024, 5000).tolist())
    plan = packing.plan_bins(lengths, packing.Capacities())
    bins = int((plan.first_bin + plan.pieces // plan.each).max())
    assert plan.pieces.sum() == 5000
    assert bins <= 1.02 * -(-sum(n * c for n, c in lengths.items()) // 1024)
    assert len(packing.plan_bins({}, packing.Capacities())) == 0
    with pytest.raises(ValueError):
        packing.plan_bins({2000: 1}, packing.Capacities())


def test_simple_8b():
    random = np.random.default_rng(1)
    cases = [
        random.integers(0, 50_000, 5000),
        np.zeros(3000),
        random.integers(0, 2, 2500),
        np.array([2**63, 5, 2**60, 15 << 60, 0, 2**60 - 1]),
        np.array([7]),
        np.concatenate([np.zeros(1000), [2**62], random.integers(0, 300, 1500)]),
    ]
    for values in cases:
        values = values.astype(np.uint64)
        stream, blocks = tokenfiles.encode(values)
        assert (tokenfiles.decode(stream, blocks, len(values)) == values).all()
    stream, _ = tokenfiles.encode(cases[0].astype(np.uint64))
    assert len(stream) < 0.4 * 5000
    assert not len(tokenfiles.decode(*tokenfiles.encode(np.zeros(0, np.uint64)), 0))


def test_files(spark, awkward, plain, tmp_path):
    path = str(tmp_path / "ids")
    tokenfiles.write_files(awkward, WORDS, path)
    found = plain(tokenfiles.read_files(spark, path, keep_ids=True)).sort_values("start")
    rows = texts_of(awkward)
    expected = Counter((i, tuple(x + [2])) for (i, _), x in zip(rows, plain_ids(WORDS, [t for _, t in rows])))
    assert Counter((i, tuple(x)) for i, x in zip(found.doc_id, found.ids)) == expected
    assert (found.start == found.n_tokens.cumsum() - found.n_tokens).all()
    assert all(checksum(x) == c for x, c in zip(found.ids, found.ids_crc32))
    ids = [i for i in found.doc_id if i is not None]
    assert ids == sorted(ids) and found.doc_id.iloc[:2].tolist() == [None, None]


def test_pieces_without_dropout_are_the_models(words):
    model = SentencePieceProcessor(model_file=PIECES)
    texts = [t for t in ODD if "▁" not in t] + [words(60, s) for s in range(10)]
    encoder = pieces.PieceEncoder(PIECES, pieces.Dropout(0.0), 0)
    ids, ends = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [model.encode(t) for t in texts]


def test_dropout_varies_and_is_lossless(awkward, empty, plain, words):
    dropout = pieces.Dropout(0.3, seed=7)
    encoder = pieces.PieceEncoder(PIECES, dropout, 1)
    for word in words(300, 11).split() + ["中文", "a▁b"]:
        symbols = [encoder.vocabulary.symbol(c) for c in f" {word}"]
        assert encoder.by_rows([symbols]) == [encoder.by_heap(symbols)]
    runs = {}
    for seed in (7, 8):
        found = plain(pieces.encode_pieces(awkward, PIECES, pieces.Dropout(0.3, seed), keep_ids=True))
        assert found.lossless.all()
        texts = Counter(pieces.decode(PIECES, ids) for ids in found.ids)
        assert texts == Counter(t for _, t in texts_of(awkward))
        runs[seed] = sorted(map(tuple, found.ids))
    assert runs[7] != runs[8]
    again = plain(pieces.encode_pieces(awkward, PIECES, dropout, keep_ids=True))
    assert sorted(map(tuple, again.ids)) == runs[7]
    assert pieces.encode_pieces(empty, PIECES).count() == 0


def cuts_of(ids):
    """The cuts of the repeated words in a text of one word."""
    text = tuple(ids.tolist() if hasattr(ids, "tolist") else ids)
    values, out, own = pieces.vocabulary(PIECES), [], ()
    for i in text:
        if own and bytes(values.decoded(np.array([i]))).startswith(b" "):
            out.append(own)
            own = ()
        own += (i,)
    return [*out, own]


def test_cuts_of_a_word_grow_with_the_documents(spark, plain):
    word, seen = "internationalization", []
    for n in (5, 50, 500):
        docs = spark.createDataFrame([(i, f"{word} {word}") for i in range(n)], "doc_id long, text string")
        found = plain(pieces.encode_pieces(docs, PIECES, pieces.Dropout(0.3), keep_ids=True))
        assert found.lossless.all()
        own = [cuts_of(ids) for ids in found.ids]
        seen.append(len({c for cuts in own for c in cuts}))
        # Repeats within a document are cut apart, too.
        assert any(len(set(cuts)) > 1 for cuts in own)
    assert 4 < seen[0] < seen[1] < seen[2] and seen[1] > 20


def test_remembered_cuts_are_those_of_the_agenda(words, monkeypatch):
    """By mask and memory, every word is cut as if its agenda were run for itself."""
    monkeypatch.setattr(pieces, "_AT_ONCE", 50)
    encoder = pieces.PieceEncoder(PIECES, pieces.Dropout(0.3, seed=7))
    texts = [t for t in ODD if t] + [words(50, s) for s in range(10)]
    for _ in range(2):
        ids, ends = encoder.encode(pa.array(texts), np.arange(len(texts)))
        for k, text in enumerate(texts):
            key = encoder._text_keys(np.array([k]))
            expected = []
            for at, word in enumerate(encoder._split(text)):
                own = pieces._mixed(key + np.array([at]).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
                expected += encoder.by_heap([encoder.vocabulary.symbol(c) for c in f" {word}"], own[0])
            assert ids[ends[k] : ends[k + 1]].tolist() == expected, text


def plain_cut(encoder, word, key):
    """The best candidate that is not skipped, over and over."""
    values = encoder.vocabulary
    symbols = [(at, values.symbol(c)) for at, c in enumerate(word)]
    while True:
        found = []
        for n, ((at, left), (_, right)) in enumerate(zip(symbols, symbols[1:])):
            made = values.pairs.get(left * values.symbols + right) if max(left, right) < values.symbols else None
            if made and not encoder.skipped(np.array([key]), np.array([at]), np.array([made]))[0]:
                found.append((values.rank[made], n, made))
        if not found:
            return values.spelt([s for _, s in symbols])
        _, n, made = min(found)
        symbols[n : n + 2] = [(symbols[n][0], made)]


@pytest.mark.parametrize("rate", [0.1, 0.6])
def test_each_occurrence_has_the_cut_of_a_plain_agenda(words, rate):
    encoder = pieces.PieceEncoder(PIECES, pieces.Dropout(rate, seed=3))
    long = ["international" * 2 + "x" * n for n in range(4, 8)]
    texts = [" ".join(["the nation", "a▁b 中文字 naïve", *long, words(20, s)]) for s in range(8)]
    ids, ends = encoder.encode(pa.array(texts), np.arange(8))
    for k, text in enumerate(texts):
        key, expected = encoder._text_keys(np.array([k])), []
        for at, word in enumerate(text.split(" ")):
            own = pieces._mixed(key + np.array([at]).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
            expected += plain_cut(encoder, f" {word}", own[0])
        assert ids[ends[k] : ends[k + 1]].tolist() == expected


def test_only_merges_that_are_taken_are_looked_at(words):
    """A word's agenda runs again only where it skips one of them."""
    encoder, text = pieces.PieceEncoder(PIECES, pieces.Dropout(0.01)), words(5000, 1)
    looked, skipped = [], encoder.skipped
    encoder.skipped = lambda own, place, piece: (looked.append(len(piece)), skipped(own, place, piece))[1]
    ids, _ = encoder.encode(pa.array([text]))
    # Every merge makes one symbol less.
    assert sum(looked) < 1.5 * (len(text) + 1 - len(ids))


def test_merges_are_found_in_the_table():
    values = pieces.vocabulary(PIECES)
    left, right = (np.array(x) for x in zip(*(divmod(k, values.symbols) for k in values.pairs)))
    found = values.merged(left, right)
    assert (found & (1 << 32) - 1).tolist() == list(values.pairs.values())
    assert (found >> 40 == values.rank[found & (1 << 32) - 1]).all()
    other = np.random.default_rng(1).integers(0, values.symbols + 9, (2, 100_000))
    there = [a < values.symbols > b and a * values.symbols + b in values.pairs for a, b in other.T.tolist()]
    assert ((values.merged(*other) < pieces._NONE) == there).all()


def test_empty_tables(spark, empty, tmp_path):
    assert packing.pack(empty, BYTES).count() == 0
    path = str(tmp_path / "none")
    tokenfiles.write_files(empty, WORDS, path)
    assert tokenfiles.read_files(spark, path).count() == 0
