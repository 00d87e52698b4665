"""Removal of repeated byte strings, by deep-shallow suffix sorting around shared anchors.

Every string of ``length`` bytes has an anchor: of the short grams in it the one with the
smallest hash, the leftmost of several. Equal strings have the same anchor at the same
place, so strings whose anchor occurs once in the corpus are not repeated. Consecutive
strings with one anchor make a run, and runs with the same anchor are compared.

A run is cut at its anchor: the suffix from the anchor on and the reversed prefix before it.
Both are sorted deep-shallow: multikey quicksort, eight bytes at a time, to a shallow depth,
then a blind trie for each group that still shares its prefix. A string of a run repeats if
another run shares enough of both, which the common prefixes of neighbours tell.

Runs with equal bytes are sorted once, with a count. An anchor with too many different runs
for one task is split into its single strings, which are counted by their hashes.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folia.llm.frames import fresh, staged, with_text
from folia.llm.texts import text_slices

_U = np.uint64
# An anchor is a gram of this many bytes (a power of two).
GRAM = 32
# Bytes that the quicksort looks at before the tries take over.
SHALLOW = 48
_POSITION_BITS = 24
_PIECE = 1 << 22


@dataclass(frozen=True)
class Repeats:
    """``length``: bytes of a repeated string, 40 to 250.

    ``runs_in_task``: different runs of one anchor that are sorted in one task.
    """

    length: int = 200
    runs_in_task: int = 40_000


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the gram at each position, doubling the hashed length at each step."""
    hashes = (data.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
    span, factor = 1, 0x2545F4914F6CDD1D
    while span < GRAM:
        mixed = hashes[:-span] * _U(factor)
        mixed ^= mixed >> _U(29)
        hashes = mixed + hashes[span:]
        span, factor = span * 2, (factor * 0x9E3779B97F4A7C15 + 2) % (1 << 64) | 1
    hashes *= _U(0xD6E8FEB86659FD93)
    hashes ^= hashes >> _U(32)
    return hashes


def _anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` grams: the leftmost position of the smallest hash."""
    mask = _U((1 << _POSITION_BITS) - 1)
    # Position in the low bits: of equal hashes the leftmost is the smallest.
    low = (hashes & ~mask) | np.arange(len(hashes), dtype=_U)
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    return (low & mask).astype(np.int64)


def _runs_of(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of one piece: start, number of strings, anchor's offset in the run, its hash."""
    hashes = _gram_hashes(data)
    anchors = _anchors(hashes, length - GRAM + 1)
    starts = np.flatnonzero(np.diff(anchors, prepend=-1))
    counts = np.diff(starts, append=len(anchors))
    return starts, counts, anchors[starts] - starts, hashes[anchors[starts]]


_BASE = 0xD1342543DE82EF95
_powers_of: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """Powers of a number modulo 2 ** 64, kept by the worker."""
    if len(_powers_of.get(base, ())) < n:
        powers = np.full(max(n, 1 << 16), base, _U)
        powers[0] = 1
        _powers_of[base] = np.cumprod(powers, dtype=_U)
    return _powers_of[base][:n]


def _content_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of the bytes of each run, from running sums."""
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * _powers(_BASE, len(data)), out=sums[1:])
    # The inverse power moves each run to the start.
    total = (sums[ends] - sums[starts]) * _powers(pow(_BASE, -1, 1 << 64), len(data))[starts]
    total ^= total >> _U(31)
    total *= _U(0x7FB5D329728EA185)
    return total ^ (total >> _U(29))


_RUNS = "doc_id bigint, text_crc bigint, key bigint, content bigint, place bigint"


def _find_runs(docs: DataFrame, length: int) -> DataFrame:
    """All runs; ``place`` holds start, strings and anchor's offset."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, limit=_PIECE):
                owners, columns = [], []
                for i, text in enumerate(rows.column("text")):
                    data = np.frombuffer(text.as_buffer() or b"", np.uint8)
                    # Long texts piece by piece; pieces overlap by less than one string.
                    for base in range(0, len(data) - length + 1, _PIECE):
                        piece = data[base : base + _PIECE + length - 1]
                        starts, counts, offsets, keys = _runs_of(piece, length)
                        ends = starts + counts + length - 1
                        content = _content_hashes(piece, starts, ends)
                        # Equal bytes around the anchor at another place are another run.
                        content ^= (offsets.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
                        place = ((starts + base) << 16) | (counts << 8) | offsets
                        owners.append(np.full(len(starts), i))
                        columns.append((keys.view(np.int64), content.view(np.int64), place))
                if not owners:
                    continue
                owner = pa.array(np.concatenate(owners))
                keys, content, place = (np.concatenate(c) for c in zip(*columns))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(owner),
                        rows.column("text_crc").take(owner),
                        pa.array(keys),
                        pa.array(content),
                        pa.array(place),
                    ],
                    ["doc_id", "text_crc", "key", "content", "place"],
                )

    return docs.mapInArrow(found, _RUNS)


def blind_trie(values: list[int], bits: int) -> tuple[list[int], list[int]]:
    """Order numbers of ``bits`` bits: their indices, and the bits each shares with the one before.

    The trie keeps at its inner nodes only the bit at which two halves differ. A number is
    led down by these bits alone, compared once with the leaf it arrives at, and
    inserted where that comparison tells.
    """
    # An inner node is [bit, smaller, larger]; a leaf is the list of indices of equal numbers.
    root: list = [0]
    for index in range(1, len(values)):
        value, node = values[index], root
        while len(node) == 3 and isinstance(node[1], list):
            node = node[2] if value >> (bits - 1 - node[0]) & 1 else node[1]
        differing = value ^ values[node[0]]
        if not differing:
            node.append(index)
            continue
        at = bits - differing.bit_length()
        parent, side, node = None, 0, root
        while len(node) == 3 and isinstance(node[1], list) and node[0] < at:
            parent, side = node, 2 if value >> (bits - 1 - node[0]) & 1 else 1
            node = node[side]
        larger = value >> (bits - 1 - at) & 1
        made = [at, node, [index]] if larger else [at, [index], node]
        if parent is None:
            root = made
        else:
            parent[side] = made
    order: list[int] = []
    shared: list[int] = []
    stack: list = [(root, 0)]
    while stack:
        node, before = stack.pop()
        if len(node) == 3 and isinstance(node[1], list):
            stack.append((node[2], node[0]))
            stack.append((node[1], before))
        else:
            order += node
            shared += [before, *[bits] * (len(node) - 1)]
    return order, shared


def deep_shallow(rows: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort byte rows within groups: the order, and the bytes each shares with the row before.

    ``rows`` is a matrix of bytes whose width is a multiple of eight; ``groups`` is
    ascending. A first row of a group shares nothing.
    """
    n, width = rows.shape
    words = rows.view(">u8").astype(_U)
    order = np.arange(n)
    fresh = np.diff(groups, prepend=-1) != 0
    shared = np.zeros(n, np.int64)
    group = np.cumsum(fresh)
    for step in range(min(SHALLOW, width) // 8):
        # Only rows that have company are looked at any further.
        alone = fresh & np.append(fresh[1:], True)
        active = np.flatnonzero(~alone)
        if not len(active):
            break
        word = words[order[active], step]
        within = np.lexsort((word, group[active]))
        order[active] = order[active][within]
        word = word[within]
        differs = np.zeros(len(active), bool)
        differs[1:] = (word[1:] != word[:-1]) & ~fresh[active][1:]
        at = active[differs]
        crossed = word[np.flatnonzero(differs)] ^ word[np.flatnonzero(differs) - 1]
        shared[at] = 8 * step + _leading_bytes(crossed)
        fresh[at] = True
        group = np.cumsum(fresh)
    firsts = np.flatnonzero(fresh)
    sizes = np.diff(firsts, append=n)
    for first, size in zip(firsts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        members = order[first : first + size]
        values = [int.from_bytes(rows[m].tobytes(), "big") for m in members]
        inside, bits = blind_trie(values, 8 * width)
        order[first : first + size] = members[inside]
        shared[first + 1 : first + size] = np.array(bits[1:]) // 8
    return order, shared


def _leading_bytes(words: np.ndarray) -> np.ndarray:
    """How many leading bytes of each word are zero."""
    count = np.zeros(len(words), np.int64)
    for i in range(1, 8):
        count += words < _U(1) << _U(64 - 8 * i)
    return count


def repeated_strings(
    contents: list[bytes],
    keys: np.ndarray,
    copies: np.ndarray,
    counts: np.ndarray,
    offsets: np.ndarray,
    length: int,
) -> np.ndarray:
    """Which strings of each run occur more than once among runs with the same key.

    ``keys`` is grouped. Returns a row per run and a column per string of it.
    """
    n = len(contents)
    most = length - GRAM + 1
    right_width, left_width = -(-length // 8) * 8, -(-most // 8) * 8
    right = np.zeros((n, right_width), np.uint8)
    left = np.zeros((n, left_width), np.uint8)
    for i, (content, offset) in enumerate(zip(contents, offsets.tolist())):
        data = np.frombuffer(content, np.uint8)
        tail = data[offset : offset + length]
        right[i, : len(tail)] = tail
        left[i, :offset] = data[:offset][::-1]
    groups = np.cumsum(np.append(0, keys[1:] != keys[:-1])) if n else keys
    sides = []
    for rows in (right, left):
        order, shared = deep_shallow(rows, groups)
        sides.append((order, shared))
    repeated = np.repeat((copies > 1)[:, None], most, axis=1)
    # Group by group a new class must begin, also where all bytes needed are none.
    starts = [np.diff(groups[order], prepend=-1) != 0 for order, _ in sides]
    for before in range(most):
        # Strings with `before` bytes ahead of the anchor.
        index = offsets - before
        valid = np.flatnonzero((index >= 0) & (index < counts))
        if len(valid) < 2:
            continue
        classes = []
        for (order, shared), first, needed in zip(sides, starts, (length - before, before)):
            own = np.empty(n, np.int64)
            own[order] = np.cumsum(first | (shared < needed))
            classes.append(own[valid])
        both = classes[0] << 32 | classes[1]
        _, which, times = np.unique(both, return_inverse=True, return_counts=True)
        twice = valid[times[which] > 1]
        repeated[twice, index[twice]] = True
    return repeated & (np.arange(most)[None, :] < counts[:, None])


def _spans(repeated: np.ndarray, length: int) -> list[list[int]]:
    """Per run: starts and ends of its repeated bytes, one after the other."""
    edges = np.diff(np.pad(repeated.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, at = np.nonzero(edges)
    ends = edges[rows, at] < 0
    values = at + np.where(ends, length - 1, 0)
    borders = np.searchsorted(rows, np.arange(len(repeated) + 1))
    return [values[a:b].tolist() for a, b in zip(borders, borders[1:])]


_CUT = "key bigint, content bigint, copies bigint, strings int, before int, bytes binary"


def _cut_runs(texts: DataFrame, length: int) -> DataFrame:
    """The bytes of the runs listed in ``items``, ``strings`` and ``before`` the anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, limit=1 << 20):
                out: list[tuple] = []
                for i in range(rows.num_rows):
                    data = rows.column("text")[i].as_buffer()
                    for item in rows.column("items")[i].as_py():
                        start, count = item["place"] >> 16, item["place"] >> 8 & 255
                        bytes_ = data.slice(start, count + length - 1).to_pybytes()
                        out.append((item["key"], item["content"], item["n"], count, item["place"] & 255, bytes_))
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                    names = ["key", "content", "copies", "strings", "before", "bytes"]
                    arrays = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return texts.mapInArrow(cut, _CUT)


def _sorted_runs(runs: DataFrame, repeats: Repeats) -> DataFrame:
    """``key, content, spans`` of runs; the runs of one key meet in a task."""
    length = repeats.length

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            # Whole keys only: what follows the last change of key waits for the next batch.
            keys = batch.column("key").to_numpy()
            changes = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if waiting and batch.num_rows and waiting[-1].column("key")[-1].as_py() != keys[0]:
                changes = np.append(0, changes)
            if len(changes) and held + int(changes[-1]) >= 8192:
                last = int(changes[-1])
                yield solve([*waiting, batch.slice(0, last)])
                waiting, held = [batch.slice(last)], batch.num_rows - last
            else:
                waiting.append(batch)
                held += batch.num_rows
        if held:
            yield solve(waiting)

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches([p for p in parts if p.num_rows])
        number = lambda name: table.column(name).to_numpy().astype(np.int64)
        repeated = repeated_strings(
            table.column("bytes").to_pylist(), number("key"), number("copies"),
            number("strings"), number("before"), length,
        )
        return pa.RecordBatch.from_arrays(
            [
                table.column("key").combine_chunks(),
                table.column("content").combine_chunks(),
                pa.array(_spans(repeated, length), pa.list_(pa.int64())),
            ],
            ["key", "content", "spans"],
        )

    together = runs.repartition("key").sortWithinPartitions("key")
    return together.mapInArrow(sort, "key bigint, content bigint, spans array<bigint>")


def _counted_strings(runs: DataFrame, length: int) -> DataFrame:
    """``key, content, spans`` of runs by counting their single strings."""

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                for i in range(row["strings"]):
                    digest = hashlib.blake2b(row["bytes"][i : i + length], digest_size=16).digest()
                    halves = (int.from_bytes(digest[a : a + 8], "little", signed=True) for a in (0, 8))
                    out.append((row["key"], row["content"], row["copies"], i, *halves))
            names = ["key", "content", "copies", "nth", "h1", "h2"]
            columns = zip(*out) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    schema = "key bigint, content bigint, copies bigint, nth bigint, h1 bigint, h2 bigint"
    strings = runs.mapInArrow(single, schema)
    often = strings.groupBy("h1", "h2").agg(F.sum("copies").alias("n")).where(F.col("n") > 1)
    spans = strings.join(often, ["h1", "h2"], "left_semi").groupBy("key", "content")
    ends = F.transform(F.array_sort(F.collect_list("nth")), lambda i: F.array(i, i + length))
    return spans.agg(F.flatten(ends).alias("spans"))


def _merged(spans: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of bytes from starts and ends in turn."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def _without_spans(texts: DataFrame, keep_text: bool) -> DataFrame:
    schema = "doc_id bigint, text_crc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                out: list[tuple] = []
                for i in range(rows.num_rows):
                    data = bytes(rows.column("text")[i].as_buffer() or b"")
                    runs = _merged(rows.column("spans")[i].as_py() or [])
                    parts, done = [], 0
                    for start, end in runs:
                        parts.append(data[done:start])
                        done = end
                    kept = b"".join([*parts, data[done:]])
                    row = (len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
                    # A cut through a character leaves bytes that no text can hold.
                    out.append((*row, kept.decode("utf-8", "ignore")) if keep_text else row)
                columns = list(zip(*out)) if out else [()] * (4 + keep_text)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
                names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"][: len(arrays)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("text_crc"), *arrays],
                    ["doc_id", "text_crc", *names],
                )

    return texts.mapInArrow(remove, schema + (", kept_text string" if keep_text else ""))


def without_repeats(
    docs: DataFrame, repeats: Repeats = Repeats(), keep_text: bool = False
) -> DataFrame:
    """Remove all bytes covered by a string of ``length`` bytes that starts elsewhere too.

    Returns one row per document: ``doc_id, text_crc, n_bytes, n_removed, n_spans,
    kept_sha256`` and, if wanted, ``kept_text``, in which characters cut in two are left
    out. Texts are taken as UTF-8; strings never run across documents; overlapping ones
    count. NULL texts are empty; texts shorter than ``length`` stay whole; repeated rows are
    documents like others, so they lose everything they share. An empty table gives no
    rows; other columns are left out.
    """
    changed, untouched = _cut(docs, repeats, keep_text, keep_text)
    return changed.unionByName(untouched)


def _cut(
    docs: DataFrame, repeats: Repeats, keep_text: bool, keep_untouched: bool
) -> tuple[DataFrame, DataFrame]:
    """Documents that hold a shared anchor, and the others."""
    length = repeats.length
    rows = with_text(docs).withColumn("text_crc", F.crc32(F.encode("text", "UTF-8")))
    runs = _find_runs(rows, length)
    shared = runs.groupBy("key").agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select("key")
    repeated = staged(runs.join(shared, "key"), "runs")
    own = F.struct("doc_id", "text_crc", "place")
    different = staged(
        repeated.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(own).alias("rep")),
        "different-runs",
    )
    item = F.struct("key", "content", "rep.place", "n")
    items = different.groupBy("rep.doc_id", "rep.text_crc").agg(F.collect_list(item).alias("items"))
    touched = repeated.select("doc_id", "text_crc").distinct()
    names = ["doc_id", "text_crc"]
    marked = touched.join(items, _equal(touched, items), "left").select(
        *(touched[n].alias(f"_{n}") for n in names), "items", F.lit(True).alias("_touched")
    )
    joined = rows.join(
        marked, rows.doc_id.eqNullSafe(F.col("_doc_id")) & (rows.text_crc == F.col("_text_crc")), "left"
    )
    whole = F.col("_touched").isNull()
    texts = staged(
        joined.select(
            *names,
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.when(whole, F.sha2(F.encode("text", "UTF-8"), 256)).alias("kept_sha256"),
            F.when(~whole | F.lit(keep_untouched), F.col("text")).alias("text"),
            whole.alias("whole"),
            "items",
        ),
        "texts",
    )
    cut = _cut_runs(texts.where(F.col("items").isNotNull()).select("text", "items"), length)
    sizes = different.groupBy("key").agg(F.count("*").alias("_runs"))
    crowded = sizes.where(F.col("_runs") > repeats.runs_in_task).select("key")
    crowded = staged(crowded, "crowded")
    if crowded.isEmpty():
        found = _sorted_runs(cut, repeats)
    else:
        few = _sorted_runs(cut.join(crowded, "key", "left_anti"), repeats)
        found = few.unionByName(_counted_strings(cut.join(crowded, "key", "left_semi"), length))
    found = staged(found.where(F.size("spans") > 0), "found")
    start = F.shiftright("place", 16)
    placed = repeated.join(found, ["key", "content"]).select(
        *names, F.transform("spans", lambda x: x + start).alias("spans")
    )
    spans = placed.groupBy(*names).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    cut_texts = texts.where(~F.col("whole")).select(*names, "text")
    matched = cut_texts.join(
        spans.select(*(F.col(n).alias(f"_{n}") for n in names), "spans"),
        cut_texts.doc_id.eqNullSafe(F.col("_doc_id")) & (cut_texts.text_crc == F.col("_text_crc")),
        "left",
    )
    result = _without_spans(matched.select(*names, "text", "spans"), keep_text)
    none = F.lit(0).cast("long")
    untouched = texts.where("whole").select(
        *names, "n_bytes", none.alias("n_removed"), none.alias("n_spans"), "kept_sha256",
        *([F.col("text").alias("kept_text")] if keep_text else []),
    )
    return result, untouched


def _equal(left: DataFrame, right: DataFrame):
    return left.doc_id.eqNullSafe(right.doc_id) & (left.text_crc == right.text_crc)


def cut_documents(docs: DataFrame, repeats: Repeats = Repeats()) -> DataFrame:
    """The documents with repeated bytes cut out of their texts, with all their columns.

    Characters cut in two go. Every document stays, if need be with an empty text; NULL
    texts stay NULL.
    """
    cut, _ = _cut(docs, repeats, keep_text=True, keep_untouched=False)
    name, code, kept, own = (fresh(docs, c) for c in ("_id", "_crc", "_kept", "_own_crc"))
    changed = cut.where(F.col("n_removed") > 0).select(
        F.col("doc_id").alias(name), F.col("text_crc").alias(code), F.col("kept_text").alias(kept)
    )
    changed = changed.dropDuplicates([name, code])
    crc = F.crc32(F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8"))
    matches = F.col("doc_id").cast("long").eqNullSafe(F.col(name)) & (F.col(own) == F.col(code))
    joined = docs.withColumn(own, crc).join(changed, matches, "left")
    return joined.withColumn("text", F.coalesce(kept, "text")).select(*docs.columns)
