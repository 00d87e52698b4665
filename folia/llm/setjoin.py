"""Jaccard self-join of word shingles along chosen paths.

Each set of shingles samples tokens one after the other: the next one is the token that is
smallest under a hash keyed by the run and by the tokens chosen before. Sets that share
their path so far are in one bucket; buckets above a size are split by the next token,
small ones are compared pair by pair. Two sets of similarity s choose the same token with
probability s, so a run finds them with at least s ** depth; runs are repeated until the
target recall is reached at the threshold.

Texts with equal sets are one set with a number of copies. A pair is counted in the first
run in which it shares a bucket, so links are counted where they are found, and no pair is
ever a row: a comparing task returns each set's number of links and a spanning forest.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from folia.llm.components import components
from folia.llm.frames import fresh, staged, with_text
from folia.llm.texts import as_text, text_slices

_U = np.uint64


@dataclass(frozen=True)
class SetJoin:
    words: int = 5
    similarity: float = 0.8
    recall: float = 0.99
    depth: int = 3
    # Sets of a bucket that are compared as they are; larger ones are split, and those that
    # no further token splits are compared block by block.
    bucket: int = 64
    seed: int = 42

    def runs(self) -> int:
        """Runs that find a pair at the threshold with the target recall at full depth."""
        found = self.similarity**self.depth
        return 1 if found >= 1 else math.ceil(math.log(1 - self.recall) / math.log(1 - found))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; all later steps rely on well-spread bits."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x = x ^ (x >> _U(27))
    x = x * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _powers(n: int) -> np.ndarray:
    base = np.full(n, 0x9E3779B97F4A7C15 | 1, _U)
    if n:
        base[0] = 1
    return np.cumprod(base, dtype=_U)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Words are what white space separates. A text of fewer words has one shingle of all of
    them, a text without words has none.
    """
    pieces = pc.utf8_split_whitespace(as_text(texts))
    flat = pieces.flatten()
    borders = pieces.offsets.to_numpy().astype(np.int64)
    ends = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    raw = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    lengths = np.diff(ends)
    full = lengths > 0
    starts = (ends[:-1] - ends[0])[full]
    borders = np.concatenate([[0], np.cumsum(full)])[borders - borders[0]]
    lengths = lengths[full]
    if not len(starts):
        return [np.zeros(0, _U) for _ in range(len(texts))]
    inside = np.arange(len(raw)) - np.repeat(starts, lengths)
    weighed = (raw.astype(_U) + _U(1)) * _powers(int(lengths.max()))[inside]
    hashes = _mixed(np.add.reduceat(weighed, starts) + lengths.astype(_U))
    size = len(hashes) - words + 1
    rolled = np.zeros(max(size, 0), _U)
    for i in range(words):
        rolled = _mixed(rolled + hashes[i : i + len(rolled)])
    sets = []
    for first, last in zip(borders, borders[1:]):
        if last - first >= words:
            sets.append(np.unique(rolled[first : last - words + 1]))
        elif last > first:
            short = np.zeros(1, _U)
            for h in hashes[first:last]:
                short = _mixed(short + h)
            sets.append(_mixed(short + _U(last - first)))
        else:
            sets.append(np.zeros(0, _U))
    return sets


def chosen_paths(tokens: np.ndarray, runs: int, depth: int, seed: int) -> np.ndarray:
    """For each run and depth the hash of the path chosen so far, as signed numbers."""
    keys = _mixed(np.arange(1, runs + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))
    paths = np.zeros((runs, depth), _U)
    for level in range(depth):
        # One multiplication by an odd number of the path orders the tokens anew.
        order = (tokens ^ keys[:, None]) * (keys | _U(1))[:, None]
        order ^= order >> _U(32)
        keys = _mixed(keys + tokens[order.argmin(axis=1)])
        paths[:, level] = keys
    return paths.reshape(-1).view(np.int64)


def _set_id(tokens: np.ndarray) -> bytes:
    """128 bits that name a set."""
    sums = [int(_mixed(tokens + _U(k)).sum(dtype=_U)) for k in (1, 2)]
    return b"".join(x.to_bytes(8, "little") for x in sums)


def _signatures(docs: DataFrame, join: SetJoin) -> DataFrame:
    runs = join.runs()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                sets = shingle_sets(rows.column("text"), join.words)
                ids = [_set_id(s) if len(s) else None for s in sets]
                paths = [
                    chosen_paths(s, runs, join.depth, join.seed) if len(s) else None for s in sets
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": rows.column("doc_id"),
                        "text_hash": rows.column("text_hash"),
                        "set_id": pa.array(ids, pa.binary()),
                        "size": pa.array([len(s) for s in sets], pa.int64()),
                        "paths": pa.array(paths, pa.list_(pa.int64())),
                    }
                )

    schema = "doc_id bigint, text_hash bigint, set_id binary, size bigint, paths array<bigint>"
    return docs.mapInArrow(signed, schema)


def _leaves(sets: DataFrame, join: SetJoin) -> DataFrame:
    """``set_id, run, key, n``: the bucket of each set in each run, if it is not alone there."""
    steps = [F.slice("paths", r * join.depth + 1, join.depth) for r in range(join.runs())]
    rows = sets.select("set_id", F.posexplode(F.array(*steps)).alias("run", "path"))
    leaves = None
    for level in range(join.depth):
        keyed = rows.withColumn("key", F.col("path")[level])
        sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
        shared = staged(keyed.join(sizes, "key"), "paths")
        last = level == join.depth - 1
        found = shared.where(F.lit(True) if last else F.col("n") <= join.bucket)
        found = found.select("set_id", "run", "key", "n")
        leaves = found if leaves is None else leaves.unionByName(found)
        rows = shared.where(F.col("n") > join.bucket).select("set_id", "run", "path")
    return leaves


def _tasks(leaves: DataFrame, join: SetJoin) -> DataFrame:
    """Per set: the buckets to compare it in, and its keys in all runs.

    A bucket all of whose sets share a bucket of one earlier run is left out: all of its pairs
    have been compared there.
    """
    runs = join.runs()
    keys = [F.max(F.when(F.col("run") == r, F.col("key"))).alias(f"k{r}") for r in range(runs)]
    per_set = leaves.groupBy("set_id").agg(*keys)
    per_set = staged(
        per_set.select("set_id", F.array(*(f"k{r}" for r in range(runs))).alias("keys")), "keys"
    )
    rows = leaves.join(per_set, "set_id")
    earlier = [
        (F.col("run") > r)
        & (F.count(F.col("keys")[r]) == F.count("*"))
        & (F.min(F.col("keys")[r]) == F.max(F.col("keys")[r]))
        for r in range(runs - 1)
    ]
    settled = earlier[0] if earlier else F.lit(False)
    for one in earlier[1:]:
        settled = settled | one
    open_keys = rows.groupBy("key", "run").agg(settled.alias("settled"))
    open_keys = open_keys.where(~F.coalesce("settled", F.lit(False))).select("key")
    kept = leaves.join(open_keys, "key").groupBy("set_id").agg(
        F.collect_list(F.struct("run", "key", "n")).alias("buckets")
    )
    return kept.join(per_set, "set_id")


_COMPARED = "task bigint, block_a int, block_b int, run int, set_id binary, copies bigint, side int, keys array<bigint>, tokens binary"


def _compare_rows(tasks: DataFrame, join: SetJoin) -> DataFrame:
    """One row for each set and group of sets to compare, with its tokens."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, limit=2 << 20):
                sets = shingle_sets(rows.column("text"), join.words)
                out: dict[str, list] = {n.split()[0]: [] for n in _COMPARED.split(", ")}
                for i, tokens in enumerate(sets):
                    set_id = rows.column("set_id")[i].as_py()
                    keys = rows.column("keys")[i].as_py()
                    copies = rows.column("copies")[i].as_py()
                    raw = tokens.tobytes()
                    for bucket in rows.column("buckets")[i].as_py():
                        blocks = -(-bucket["n"] // join.bucket)
                        own = int.from_bytes(set_id[:8], "little") % blocks
                        for other in range(blocks):
                            pair = (min(own, other), max(own, other))
                            side = int(own == pair[1])
                            values = (bucket["key"], *pair, bucket["run"], set_id, copies, side, keys, raw)
                            for column, value in zip(out.values(), values):
                                column.append(value)
                    if len(out["task"]) >= 256:
                        yield pa.RecordBatch.from_pydict(out, _ARROW)
                        out = {n: [] for n in out}
                if out["task"]:
                    yield pa.RecordBatch.from_pydict(out, _ARROW)

    return tasks.mapInArrow(spread, _COMPARED)


_ARROW = pa.schema(
    [
        ("task", pa.int64()),
        ("block_a", pa.int32()),
        ("block_b", pa.int32()),
        ("run", pa.int32()),
        ("set_id", pa.binary()),
        ("copies", pa.int64()),
        ("side", pa.int32()),
        ("keys", pa.list_(pa.int64())),
        ("tokens", pa.binary()),
    ]
)


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two sets share."""
    n = len(sets)
    if n == 2:
        both = np.intersect1d(sets[0], sets[1], assume_unique=True)
        return np.array([[len(sets[0]), len(both)], [len(both), len(sets[1])]])
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    first = np.flatnonzero(np.diff(tokens, prepend=tokens[0] ^ _U(1)))
    times = np.diff(first, append=len(tokens))
    column = np.repeat(np.arange(len(first)), times)
    # Tokens of one set alone add nothing to what two sets share.
    several = np.repeat(times > 1, times)
    owner, column = owner[several], column[several]
    shared = np.zeros((n, n), np.int64)
    # A bounded number of tokens at a time.
    _, column = np.unique(column, return_inverse=True)
    for base in range(0, int(column.max(initial=-1)) + 1, 1 << 15):
        inside = (column >= base) & (column < base + (1 << 15))
        dense = np.zeros((n, min(1 << 15, int(column.max()) + 1 - base)), np.float32)
        dense[owner[inside], column[inside] - base] = 1
        shared += np.rint(dense @ dense.T).astype(np.int64)
    return shared


def _compared(group: list[dict], join: SetJoin) -> Iterator[tuple[bytes, int, bytes]]:
    """Each linked set of a group, the copies it is linked with, and a root of its links."""
    sets = [np.frombuffer(g["tokens"], _U) for g in group]
    sizes = np.array([len(s) for s in sets])
    shared = _shared_counts(sets)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = shared >= join.similarity * union - 1e-9
    np.fill_diagonal(linked, False)
    if group[0]["block_a"] != group[0]["block_b"]:
        side = np.array([g["side"] for g in group])
        linked &= side[:, None] != side[None, :]
    for earlier in range(group[0]["run"]):
        keys = [g["keys"][earlier] for g in group]
        known = np.array([k is not None for k in keys])
        value = np.array([k or 0 for k in keys])
        linked &= ~((value[:, None] == value[None, :]) & known[:, None] & known[None, :])
    if not linked.any():
        return
    counts = linked @ np.array([g["copies"] for g in group])
    root = np.arange(len(group))
    while True:
        lowest = np.where(linked, root[None, :], len(group)).min(axis=1)
        after = np.minimum(root, lowest)
        after = after[after]
        if (after == root).all():
            break
        root = after
    for i in np.flatnonzero(counts):
        yield group[i]["set_id"], int(counts[i]), group[root[i]]["set_id"]


def _verify(rows: DataFrame, join: SetJoin) -> DataFrame:
    """``set_id, links, root`` from the groups of rows; a group has at most two blocks."""
    names = ["task", "block_a", "block_b"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        for batch in batches:
            out: list[tuple[bytes, int, bytes]] = []
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            changes = np.zeros(batch.num_rows, bool)
            for c in columns:
                changes[1:] |= c[1:] != c[:-1]
            for first, last in zip(starts := [0, *np.flatnonzero(changes)], [*starts[1:], batch.num_rows]):
                rows = batch.slice(first, last - first).to_pylist()
                if rows and group and any(rows[0][n] != group[0][n] for n in names):
                    out += _compared(group, join)
                    group = []
                group += rows
            yield _links(out)
        if group:
            yield _links(list(_compared(group, join)))

    def _links(out: list) -> pa.RecordBatch:
        ids, links, roots = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(links, pa.int64()), pa.array(roots, pa.binary())],
            ["set_id", "links", "root"],
        )

    together = rows.repartition(*names).sortWithinPartitions(*names)
    return together.mapInArrow(compare, "set_id binary, links bigint, root binary")


def similar_documents(docs: DataFrame, join: SetJoin = SetJoin()) -> DataFrame:
    """Group documents by links of at least the given Jaccard similarity.

    Returns one row per document: ``doc_id, text_hash, class_id, n_links, kept``.
    ``class_id`` is the smallest ``doc_id`` of all documents that links lead to, itself
    included, ``n_links`` the number of other documents linked directly, and one row of
    each class is kept. NULL texts count as empty; texts without words are linked with
    nothing and kept. Repeated rows are documents of their own and links of each other; of
    repeated rows with equal ids and texts one is kept. A class of NULL ids alone has the
    class id NULL. An empty table gives no rows; other columns are left out.
    """
    rows = with_text(docs).withColumn("text_hash", F.xxhash64("text"))
    signed = staged(_signatures(rows, join), "signatures")
    found = signed.where(F.col("set_id").isNotNull())
    first = F.min(F.struct("doc_id", "text_hash"))
    sets = staged(
        found.groupBy("set_id").agg(
            F.count("*").alias("copies"), first.alias("rep"), F.first("paths").alias("paths")
        ),
        "sets",
    )
    tasks = staged(_tasks(_leaves(sets, join), join), "tasks")
    wanted = tasks.join(sets.select("set_id", "copies", "rep"), "set_id").select(
        "set_id", "keys", "buckets", "copies",
        F.col("rep.doc_id").alias("_id"), F.col("rep.text_hash").alias("_hash"),
    )
    # Any of the rows with this id and text will do; the same set is then read twice at most
    # where rows are repeated, and taken once.
    texts = rows.join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    ).select("set_id", "keys", "buckets", "copies", "text")
    repeated = found.groupBy("doc_id", "text_hash").count().where(F.col("count") > 1)
    if not repeated.isEmpty():
        texts = texts.dropDuplicates(["set_id"])
    links = staged(_verify(_compare_rows(texts, join), join), "set-links")
    counted = links.groupBy("set_id").agg(F.sum("links").alias("links"))
    grouped = components(links.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    joined = (
        sets.select("set_id", "copies", "rep")
        .join(counted, "set_id", "left")
        .join(grouped.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("component", F.coalesce("component", "set_id"))
    )
    joined = staged(joined, "set-classes")
    best = joined.groupBy("component").agg(F.min("rep").alias("best"))
    classes = joined.join(best, "component").select(
        "set_id", "best", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    own = F.struct("doc_id", "text_hash")
    result = signed.select("doc_id", "text_hash", "set_id").join(classes, "set_id", "left").select(
        "doc_id",
        "text_hash",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.col("best").isNull() | own.eqNullSafe(F.col("best"))).alias("kept"),
    )
    if repeated.isEmpty():
        return result
    # Of equal rows only one may stay; only those are numbered.
    twice = result.join(repeated.drop("count"), ["doc_id", "text_hash"], "left_semi")
    once = result.join(repeated, ["doc_id", "text_hash"], "left_anti")
    counts = twice.groupBy("doc_id", "text_hash", "class_id", "n_links", "kept").count()
    again = counts.select(
        "doc_id", "text_hash", "class_id", "n_links",
        F.explode(F.sequence(F.lit(1), F.col("count"))).alias("_nth"), "kept",
    )
    again = again.withColumn("kept", F.col("kept") & (F.col("_nth") == 1)).drop("_nth")
    return once.unionByName(again)


def one_of_each(docs: DataFrame, join: SetJoin = SetJoin()) -> DataFrame:
    """The documents that ``similar_documents`` keeps, with all their columns."""
    decided = staged(similar_documents(docs, join).select("doc_id", "text_hash", "kept"), "decided")
    by = decided.groupBy("doc_id", "text_hash").agg(
        F.max("kept").alias("kept"), F.count("*").alias("rows")
    )
    name, code, own = (fresh(docs, c) for c in ("_id", "_hash", "_text_hash"))
    pair = [F.col("doc_id").alias(name), F.col("text_hash").alias(code)]
    hashed = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.withColumn(own, hashed)
    matches = F.col("doc_id").cast("long").eqNullSafe(F.col(name)) & (F.col(own) == F.col(code))
    kept = rows.join(by.where(~F.col("kept")).select(*pair), matches, "left_anti")
    more = by.where(F.col("kept") & (F.col("rows") > 1))
    if more.isEmpty():
        return kept.drop(own)
    more = more.select(*pair)
    single = kept.join(more, matches, "left_anti")
    twice = kept.join(more, matches, "left_semi").dropDuplicates(["doc_id", own])
    return single.unionByName(twice).drop(own)
