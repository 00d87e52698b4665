"""Encoding by an index of pair occurrences, against the library and step by step."""

import random
from hashlib import sha256

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from folia.llm import catalog, pairindex, tokenids

from tests.llm.test_tokens import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")
MORE = [
    "aaaaaaa abababab aaaab", "İstanbul ́x é Å", "<|startoftext|><|endoftext|>a<|endo",
    "x" * 30_000, "he" * 5_000 + "!?" * 300, "word " * 4_000, "1234567890" * 50,
]


def library():
    return Tokenizer.from_file(PATH)


def one_by_one(merges, word):
    """Of all pairs the one of lowest rank, the first of them, until there is none."""
    symbols = [merges.vocabulary[c] for c in word[:-1]] + [merges.vocabulary[word[-1] + merges.end]]
    while True:
        ranked = [
            (merges.ranks[a << 24 | b], i)
            for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
            if a << 24 | b in merges.ranks
        ]
        if not ranked:
            return symbols
        rank, i = min(ranked)
        symbols[i : i + 2] = [merges.pairs[rank][2]]


def small(merges, letters="abc"):
    made = dict.fromkeys(left + right for left, right in merges)
    vocabulary = {t: i for i, t in enumerate([*letters, *(c + "." for c in letters), *made])}
    return pairindex.Merges({"vocab": vocabulary, "merges": merges, "end_of_word_suffix": "."})


def test_merges_one_by_one():
    """Random vocabularies and words full of repetitions, many words at once."""
    for seed in range(30):
        source = random.Random(seed)
        tokens = list("abc") + ["a.", "b.", "c."]
        merges, made = [], set()
        for _ in range(25):
            left, right = source.choice([t for t in tokens if "." not in t]), source.choice(tokens)
            if left + right not in made and left + right not in tokens:
                made.add(left + right)
                merges.append((left, right))
                tokens.append(left + right)
        rules = small(merges)
        words = list({"".join(source.choices("aab", k=source.randint(1, 14))) for _ in range(60)})
        assert rules.ids(words) == [one_by_one(rules, w) for w in words]
    assert small([("a", "b")]).ids([]) == []


def test_merges_out_of_order():
    with pytest.raises(ValueError):
        small([("ab", "c"), ("a", "b")])
    with pytest.raises(ValueError):
        small([("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")])


def test_ids_of_the_library(words, monkeypatch):
    monkeypatch.setattr(tokenids, "REMEMBERED_WORDS", 60)
    monkeypatch.setattr(pairindex, "REMEMBERED_WORDS", 60)
    texts = ODD + MORE + [words(50, seed) for seed in range(20)]
    encoder, expected = pairindex.PairEncoder(PATH), library().encode_batch(texts, add_special_tokens=False)
    for _ in range(3):
        ids, ends = encoder.encode(pa.array(texts))
        for text, a, b, own in zip(texts, ends, ends[1:], expected):
            assert ids[a:b].tolist() == own.ids, text[:40]


def test_forgetting_keeps_the_most_frequent(monkeypatch):
    monkeypatch.setattr(tokenids, "REMEMBERED_WORDS", 40)
    encoder = pairindex.PairEncoder(PATH)
    for k in range(30):
        encoder.encode(pa.array([f"always {'often ' * (k % 2)}" + " ".join(f"w{k}x{i}" for i in range(9))]))
        assert len(encoder._place) <= 60
    assert "always" in encoder._place


def test_whole_table(spark, awkward, empty, plain):
    encoded = pairindex.encode(awkward, PATH)
    found = plain(pairindex.digests(pairindex.decode(encoded, PATH)))
    tokenizer, expected = library(), []
    for row in awkward.collect():
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        sums = [sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text)]
        expected.append((row["doc_id"], len(ids), *sums))
    rows = list(found.itertuples(index=False, name=None))
    assert sorted(rows, key=str) == sorted(expected, key=str)
    assert pairindex.digests(pairindex.decode(pairindex.encode(empty, PATH), PATH)).count() == 0


def test_query(spark, plain):
    sf = "/root/testdata/sf0.001"
    found = {r["doc_id"]: r for r in catalog.op12_pair_index(spark, sf).collect()}
    tokenizer = library()
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(found)
    for row in rows:
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        own = found[row["doc_id"]]
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert own["decoded_sha256"] == sha256(text.encode()).hexdigest()
