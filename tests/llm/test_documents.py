"""Shards, language, similar documents, repeated strings, personal data, and the pipeline."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

import corpus_pipeline
from folia.llm import components, language, pii, setjoin, sharding, suffixes


def rows_of(awkward):
    return [(r["doc_id"], r["text"]) for r in awkward.collect()]


# Shards


def test_shards(spark, awkward, empty, plain):
    found = plain(sharding.balanced_shards(awkward, 4)).sort_values("start")
    expected = Counter((i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t in rows_of(awkward))
    assert Counter(zip(found.doc_id, found["size"], found.text_crc32)) == expected
    total = found["size"].sum()
    assert (found.shard == (2 * found.start + found["size"]) * 4 // (2 * total)).all()
    for _, own in found.groupby("shard"):
        assert own.slot.tolist() == list(range(len(own)))
    assert sharding.balanced_shards(empty, 4).count() == 0
    many = spark.range(1000).selectExpr("1L AS doc_id", "repeat('x', 99) AS text")
    assert {r["count"] for r in sharding.balanced_shards(many, 8).groupBy("shard").count().collect()} == {125}


# Language


def test_language(spark, empty, plain):
    source = random.Random(3)
    ways = {"aa": "kalomiteru", "bb": "shabrenovid", "cc": "xyqwzpfght"}
    text = lambda lang, n: " ".join("".join(source.choices(ways[lang], k=source.randint(2, 7))) for _ in range(n))
    rows = [(i, text(lang, source.randint(3, 60)), lang) for i, lang in enumerate(sorted(ways) * 120)]
    docs = spark.createDataFrame([*rows, (900, None, "aa"), (901, "", None), (902, "12 34 !", "bb"), (None, text("cc", 9), "cc")], "doc_id long, text string, lang string")
    model = language.train(docs, language.Training(per_language=60))
    told = docs.withColumn("lang_pred", language.F.lit("clash")).withColumn("held_out", language.held_out())
    found = plain(language.identify(told, model))
    assert len(found) == docs.count() and list(found.columns)[:3] == ["doc_id", "text", "lang"]
    own = found[found.doc_id.map(lambda i: i is not None and i < 900)]
    assert (own.held_out == own.doc_id.map(lambda i: crc32(str(i).encode()) % 3 == 1)).all()
    assert (own.lang_pred == own.lang)[own.held_out.astype(bool)].mean() >= 0.97
    rest = found[found.doc_id.isin([900, 901, 902])]
    assert set(rest.lang_pred) == {"und"} and rest.lang_rejected.all() and (rest.lang_score == 0).all()
    assert found.lang_score.between(0, 1).all()
    assert own.lang_rejected.mean() < 0.02
    # Without labels there is no model, and all is undetermined.
    assert language.train(empty) is None
    assert language.identify(empty, model).count() == 0
    assert set(plain(language.identify(docs, None)).lang_pred) == {"und"}


# Similar documents


def brute_similar(rows, t=0.8):
    sets = []
    for _, text in rows:
        w = (text or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    n = len(rows)
    linked = [[i != j and bool(sets[i]) and len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        root = [min([root[i], *(root[j] for j in range(n) if linked[i][j])]) for i in range(n)]
    groups = defaultdict(list)
    for i in range(n):
        groups[root[i]].append(rows[i][0])
    smallest = {r: min(ids, key=lambda x: (x is not None, x or 0)) for r, ids in groups.items()}
    return [(rows[i][0], smallest[root[i]], sum(linked[i])) for i in range(n)], len(groups)


def test_shingles(words):
    texts = ["", "a b", " a  b ", "a b c d e", "a b c d e f", words(500, 1)]
    sets = setjoin.shingle_sets(setjoin.pa.array(texts), 5)
    assert [len(s) for s in sets[:5]] == [0, 1, 1, 1, 2]
    w = texts[5].split()
    assert len(sets[5]) == len({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    assert (sets[1] == sets[2]).all() and sets[1][0] != sets[3][0]


def test_similar(awkward, empty, plain):
    found = plain(setjoin.similar_documents(awkward))
    expected, groups = brute_similar(rows_of(awkward))
    assert Counter(zip(found.doc_id, found.class_id, found.n_links)) == Counter(expected)
    assert found.kept.sum() == groups
    kept = setjoin.one_of_each(awkward)
    assert kept.columns == awkward.columns and kept.count() == groups
    assert setjoin.similar_documents(empty).count() == 0 and setjoin.one_of_each(empty).count() == 0


def test_similar_with_split_buckets(spark, words, plain):
    """A crowd of near copies, buckets of a few sets, and pairs around the threshold."""
    source, rows = random.Random(4), []
    base = words(80, 20).split()
    for i in range(60):
        own = list(base)
        own[source.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(own)))
    for i in range(60, 120):
        own = words(100, 30 + i // 4).split()
        for _ in range(i % 4):
            own[source.randrange(100)] = f"y{i}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = setjoin.SetJoin(bucket=8, recall=0.9999)
    found = plain(setjoin.similar_documents(docs, join))
    expected, _ = brute_similar(rows)
    assert sorted(zip(found.doc_id, found.class_id, found.n_links)) == expected


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5), (None, 3), (200, 205), (205, 203)]
    found = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in found:
        groups[r["component"]].add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(61)), [100, 101], [200, 203, 205]]
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Repeated strings


def brute_repeats(texts, length):
    counts = Counter(d[i : i + length] for d in texts for i in range(len(d) - length + 1))
    out = []
    for d in texts:
        mask = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                mask[i : i + length] = True
        out.append(mask)
    return out


def digest(data, mask):
    kept = np.frombuffer(data, np.uint8)[~mask].tobytes()
    spans = int((np.diff(np.append(False, mask).astype(int)) == 1).sum())
    return len(data), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("crowd", [40_000, 2])
def test_repeats(awkward, empty, plain, crowd):
    found = plain(suffixes.without_repeats(awkward, suffixes.Repeats(200, crowd), keep_text=True))
    rows = rows_of(awkward)
    texts = [(t or "").encode() for _, t in rows]
    masks = brute_repeats(texts, 200)
    expected = Counter((i, *digest(d, m)) for (i, _), d, m in zip(rows, texts, masks))
    assert Counter(zip(found.doc_id, found.n_bytes, found.n_removed, found.n_spans, found.kept_sha256)) == expected
    assert found.n_removed.sum() > 0
    cut = suffixes.cut_documents(awkward)
    assert cut.columns == awkward.columns and cut.count() == awkward.count()
    assert suffixes.without_repeats(empty).count() == 0


def test_repeats_of_many_kinds():
    source = random.Random(9)
    letters = b"abcdefgh "
    piece = lambda n: bytes(source.choice(letters) for _ in range(n))
    for length in (64, 100, 200):
        passages = [piece(source.randint(length - 30, length + 150)) for _ in range(6)]
        docs = [b"".join(source.choice(passages)[source.choice([0, 3]) :] if source.random() < 0.5 else piece(source.randint(0, 200)) for _ in range(source.randint(0, 6))) for _ in range(25)]
        docs += [b"a" * 450, b"ab" * 200, b"\0" * 210, b""]
        groups = defaultdict(list)
        for k, d in enumerate(docs):
            if len(d) < length:
                continue
            data = np.frombuffer(d, np.uint8)
            starts, counts, offsets, keys = suffixes._runs_of(data, length)
            for q, s, c, o in zip(keys.tolist(), starts.tolist(), counts.tolist(), offsets.tolist()):
                groups[q, d[s : s + c + length - 1], o].append((k, s, c))
        order = sorted(groups)
        numbers = lambda f: np.array([f(g) for g in order])
        repeated = suffixes.repeated_strings(
            [g[1] for g in order], np.array([g[0] for g in order], np.uint64), numbers(lambda g: len(groups[g])),
            numbers(lambda g: groups[g][0][2]), numbers(lambda g: g[2]), length,
        )
        masks = [np.zeros(len(d), bool) for d in docs]
        for g, spans in zip(order, suffixes._spans(repeated, length)):
            for k, s, _ in groups[g]:
                for a, b in zip(spans[::2], spans[1::2]):
                    masks[k][s + a : s + b] = True
        assert all((a == b).all() for a, b in zip(masks, brute_repeats(docs, length)))


def test_long_texts_in_pieces(monkeypatch, spark, words, plain):
    monkeypatch.setattr(suffixes, "_PIECE", 1000)
    text = words(900, 40)
    data = text.encode()
    long_text = np.frombuffer(data, np.uint8)
    whole = suffixes._runs_of(long_text, 200)
    assert whole[1].sum() == len(data) - 199


def test_blind_trie():
    source = random.Random(2)
    for _ in range(100):
        values = [int.from_bytes(bytes(source.choice(b"ab") for _ in range(8)), "big") if source.random() < 0.7 else 5 for _ in range(source.randint(1, 12))]
        order, shared = suffixes.blind_trie(values, 64)
        assert [values[i] for i in order] == sorted(values)
        assert all(shared[i] == 64 - (values[order[i]] ^ values[order[i - 1]]).bit_length() for i in range(1, len(values)))


# Personal data


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    good = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p.lstrip("0")[:5] or 0) <= 255 for p in m[0].split(".")),
        "card": lambda m: 12 <= len(digits(m)) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits(m)[::-1])) % 10 == 0,
        "phone": lambda m: 9 <= len(digits(m)) <= 15,
    }
    found = [(*m.span(), k) for k, p in zip(pii.KINDS, (EMAIL, IP, CARD, PHONE)) for m in p.finditer(text) if good[k](m)]
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans():
    source = random.Random(6)
    parts = ["a@b.c@d.e", "x@@y.z", "q.w@e", "1.2.3.4.5", "300.1.1.1", "+12 (34) 5678-90", "+1-2-3", "4111 1111 1111 1111", "4111-1111-1111-1112", "007.08.9.255", "é@b.co", "@", ".", "+", " ", "12", "a%b@c-d.e-f."]
    for _ in range(500):
        text = "".join(source.choices(parts, k=8))
        assert pii.base_spans(text) == brute_base(text), text


def personal(spark, n=400):
    source = random.Random(8)

    def card():
        head = "".join(source.choices("0123456789", k=15))
        return next(head + d for d in "0123456789" if pii.luhn(head + d))

    rows = []
    for i in range(n):
        number = "".join(source.choices("0123456789", k=9))
        kinds = [f"mail ana{i}@firm{i}.example.org now", f"host 10.{i % 256}.3.4 up", f"card {card()} paid", f"call +49 {number} today", f"order {number[:4]}-{i} of 2024"]
        rows.append((i, " ".join(source.sample(kinds, 3))))
    return spark.createDataFrame([*rows, (n, None), (n + 1, ""), (None, "no data")], "doc_id long, text string")


def test_personal_data(spark, empty, plain):
    docs = personal(spark)
    model = pii.train(docs)
    found = docs.withColumn("pii", pii.F.lit("clash"))
    found = [(r["text"], r["pii"]) for r in pii.find(found, model, redact=True).collect()]
    for text, own in found:
        base = brute_base(text or "")
        assert own["base"] == pii.listed(base)
        spans = own["spans"].split(",") if own["spans"] else []
        assert set(pii.listed(base).split(",")) - {""} <= set(spans)
        assert sum(own[f"n_{k}"] for k in pii.KINDS) == len(base)
        if text is None:
            assert own["redacted"] is None
        else:
            assert not brute_base(own["redacted"])
    # Written otherwise, such data are found by the trees alone; prices and dates are not.
    text = "mail ana7 [at] firm7 [dot] example [dot] org now; it cost 12.50 on 2024-01-02"
    added = pii.all_spans(text, pii.base_spans(text), model)
    assert [(s[2], text[s[0] : s[1]]) for s in added] == [("email", "ana7 [at] firm7 [dot] example [dot] org")]
    assert pii.train(empty) is None and pii.find(empty, None).count() == 0
    assert pii.redacted("ab1.2.3.4c", [(2, 9, "ip"), (4, 6, "card")]) == "ab[IP]c"


def test_proposals_are_those_of_the_generators():
    source = random.Random(12)
    gap = lambda: source.choice(["", " ", "\n", "\u00a0"])
    for _ in range(3000):
        left, right = source.choice(["[]", "()", "{}", "<>", "[)", "  "])
        at, dot = source.choice(["at", "AT", "@"]), source.choice(["dot", "DOT", "."])
        sign = lambda word: f"{gap()}{left}{gap()}{word}{gap()}{right}{gap()}"
        text = f"{source.choice(['', 'look at it ', 'x '])}ana{sign(at)}firm{source.choice([sign(dot), '.'])}org 12"
        found = {(*m.span(), k) for k in pii.KINDS for m in pii._GENERATORS[k].finditer(text)}
        assert set(pii.proposals(text)) == found, text
    assert [s[2] for s in pii.proposals("ana [ at ] firm [ dot ] org")] == ["email"]


def test_disguised_data_of_the_corpus_are_no_negatives(spark):
    """A third of the addresses is disguised in the corpus itself."""
    source, rows, hidden = random.Random(14), [], {}
    for i in range(600):
        if i % 3:
            rows.append((i, f"mail ana{i}@firm{i}.example.org now, host 10.{i % 256}.3.{i % 200} up"))
        else:
            hidden[i] = source.choice([f"ana{i} [at] firm{i} [dot] example [dot] org", f"ana{i}[at]firm{i}[dot]example[dot]org"])
            rows.append((i, f"mail {hidden[i]} now, look at example.org on 2024-01-{i % 28 + 1:02}, {i} @ 12.50"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.train(docs)
    right = 0
    for i, text in rows:
        added = [text[a:b] for a, b, _ in pii.all_spans(text, pii.base_spans(text), model)]
        right += i in hidden and added == [hidden[i]]
    assert right >= 0.95 * len(hidden)
    for text in (t for i, t in rows if i in hidden):
        for values, label in pii.examples(text, 1):
            assert label == 0 and not (values[0] == 0 and values[pii.FEATURES.index("top_level")] == 3 and values[1] > 25)


# The pipeline


def test_pipeline(spark, words, plain):
    source = random.Random(1)
    rows = [(i, words(source.randint(8, 200), 100 + i), "en") for i in range(60)]
    rows += [(60, rows[0][1], "en"), (61, None, "en"), (62, "", None), (63, "12 34", "en")]
    rows += [(64, f"{rows[1][1]} x1 x2 x3", "en"), (65, f"call +49 123456789 {words(30, 900)}", "en")]
    passage = words(60, 901)
    rows += [(66, f"{words(20, 902)} {passage}", "en"), (67, f"{passage} {words(25, 903)}", "en")]
    docs = spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        seen[name] = plain(out)
        docs = spark.createDataFrame(out.collect(), out.schema)
    ids = {name: set(found.doc_id) for name, found in seen.items()}
    everything = {r[0] for r in rows}
    assert ids["language"] == everything - {61, 62, 63}
    left = [r[:2] for r in rows if r[0] in ids["language"]]
    expected, groups = brute_similar(left)
    assert len(ids["similar"]) == groups and ids["similar"] == {c for _, c, _ in expected}
    left = [(i, t.encode()) for i, t, _ in rows if i in ids["similar"]]
    masks = brute_repeats([t for _, t in left], 200)
    after = {i: np.frombuffer(t, np.uint8)[~m].tobytes().decode() for (i, t), m in zip(left, masks)}
    assert dict(zip(seen["repeats"].doc_id, seen["repeats"].text)) == after
    assert passage not in "".join(after.values())
    clean = dict(zip(seen["personal"].doc_id, seen["personal"].text))
    assert clean[65].startswith("call [PHONE] ") and clean[2] == rows[2][1]
    assert (seen["personal"].n_chars == seen["personal"].text.map(len)).all()
    assert ids["pack"] == ids["personal"]
    assert seen["pack"].groupby("sequence_id").length.sum().max() <= 1024


def test_stages_keep_columns_of_any_name(spark, words):
    """Names that the operators use themselves, NULL ids, repeated rows, and an empty table."""
    names = "_id _hash _crc _kept _own_crc _text_hash pii lang_pred lang_score document kept spans set_id n id".split()
    base = [(i, words(60, 500 + i)) for i in range(12)]
    base += [(3, base[3][1]), (None, words(50, 600)), (None, words(50, 600)), (20, base[5][1]), (21, None), (None, None)]
    rows = [(i, t, "en", "s", len(t or ""), *(f"{i} {k}" for k in names)) for i, t in base]
    columns = "doc_id long, text string, lang string, source string, n_chars long, "
    docs = spark.createDataFrame(rows, columns + ", ".join(f"{n} string" for n in names))
    for start in (docs, docs.limit(0)):
        kept = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, kept, "")
            assert out.columns == docs.columns, name
            found = out.collect()
            assert all([r[n] for n in names] == [f"{r['doc_id']} {k}" for k in names] for r in found), name
            kept = spark.createDataFrame(found, out.schema)
        ids = [r["doc_id"] for r in found]
        assert sorted(ids, key=str) == ([] if start is not docs else sorted([*range(12), None], key=str))
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, "").collect()
        assert {r["doc_id"] for r in packed} == set(ids)


def test_registered():
    import __spark_entry__ as registry

    names = set(registry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {re.match(r"op\d+_", n)[0] for n in names if n.startswith("op")}
    assert "pipeline" in names


class AcceptsAll:
    thresholds = dict.fromkeys(pii.KINDS, 0.0)

    def scores(self, rows):
        return np.ones(len(rows))


ACCEPTS_ALL = AcceptsAll()


def test_long_numbers_and_many_addresses():
    """Numbers longer than Python converts, and a text full of addresses in linear time."""
    text = "x 1.2.3." + "0" * 5000 + " y 1.2.3." + "9" * 5000 + " z 1.2.3.0004"
    assert pii.base_spans(text) == brute_base(text)
    assert [text[a:b][-4:] for a, b, k in pii.base_spans(text) if k == "ip"] == ["0000", "0004"]

    def seconds(times):
        text = "write to ana.b@firm.org or bo [at] firm [dot] org, 10.0.0.1, +49 30 1234567; " * times
        start = time.process_time()
        spans = pii.all_spans(text, pii.base_spans(text), ACCEPTS_ALL)
        assert len(spans) >= 4 * times
        assert not any(a[1] > b[0] for a, b in zip(spans, spans[1:]) if "email" == a[2] == b[2])
        return time.process_time() - start

    seconds(100)
    assert seconds(16_000) < 16 * max(seconds(2_000), 0.2)
