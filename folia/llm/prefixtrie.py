"""The trie of conversations' first turns, rolled up by centroid decomposition.

A node is a distinct sequence of first turns. It is named by its depth and the smallest
conversation that starts with it. Sequences are told apart by the exclusive-or of 120 hashed bits
of each turn with its place, which are prefix sums, so that a long conversation is
dealt out in blocks of turns.

Sums over subtrees are made by decomposing the forest of parent edges. The centroid of a
component is its deepest node with at least half of the weight beneath it; the nodes with at least
half are the path from the component's top to it. What the centroid and all beneath it hold is
summed up once and added to the nodes of that path. Then the centroid is taken out: the components
of its children and what is left above go the same way, with half of the weight at most.

A node weighs as much as it has members: then the weight beneath a node is the number of turns
its members have from there on, which grouping gives without a walk through the tree. Each
round splits all components that are larger than a task may hold, at once, by joins and
aggregates over all nodes; components that fit are decomposed further inside of tasks.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from folia.llm.frames import staged
from folia.llm.groups import sorted_by, whole_groups
from folia.operators.ids import with_dense_ids

# Turns of a conversation, and rows of a sorted table, that are summed up together.
_BLOCK = 10_000
# Conversations whose ids are written in one text, as a power of two.
_CHUNK = 9
# Keys with more than this share of all rows are joined apart; there are at most as many.
_HEAVY = 1000

_KEY = ["depth", "p", "q"]
_TOP = ["top_conv", "top_depth"]


@dataclass(frozen=True)
class Heads:
    """Conversations are rebuilt on the first turns of another one.

    Conversation ``c`` starts with the first ``h`` turns of ``c - c % group``, and goes on with its
    own after its first ``h``; ``h`` is the CRC-32 of ``c`` in decimals modulo ``turns``.
    """

    group: int = 100
    turns: int = 6


@dataclass(frozen=True)
class Rollup:
    """``weight`` of a component that a task decomposes, ``components`` split at a time.

    At most ``components`` rows are sent to all tasks: larger tables raise ``weight``.
    """

    weight: int = 100_000
    components: int = 1_000_000


def _lanes(text: Column) -> list[Column]:
    """Two numbers of 60 hashed bits."""
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16)]


def _joined(rows: DataFrame, table: DataFrame, keys: list[str], heavy: Column, how: str = "inner") -> DataFrame:
    """A join with the few ``heavy`` rows of ``table`` sent to all tasks."""
    hot, cold = F.broadcast(table.where(heavy)), table.where(~heavy)
    rest = rows.join(F.broadcast(table.where(heavy).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(cold, keys, how))


def _in_order(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with a running ``id`` in order, and each conversation's first id and number of turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    first, second = _lanes(content)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        first.alias("a"),
        second.alias("b"),
        F.length(text).cast("long").alias("letters"),
    )
    rows = with_dense_ids(turns, ["conv_id", "turn", "role", "text"], 0)
    rows = staged(rows.select("conv_id", "id", "a", "b", "letters"), "turns")
    spans = rows.groupBy("conv_id").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    return rows, staged(spans, "spans")


def _paths(conversations: DataFrame, heads: Heads | None) -> tuple[DataFrame, DataFrame]:
    """The turns of all conversations as rebuilt, and every conversation's number ``n`` of them."""
    rows, spans = _in_order(conversations)
    if heads is None:
        plans = spans.withColumn("h", F.lit(0)).withColumn("taken", F.lit(0))
    else:
        h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads.turns
        plans = spans.select("conv_id", "first", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % heads.group).alias("base"))
        bases = spans.where(F.col("conv_id") % heads.group == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
        plans = plans.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    plans = plans.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    plans = staged(plans, "plans")
    # A conversation meets its turns in blocks of the running id.
    block = F.floor(F.col("id") / _BLOCK)
    last = F.col("first") + F.col("n") - 1
    spread = plans.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / _BLOCK), F.floor(last / _BLOCK))))
    placed = rows.withColumn("block", block).join(spread.drop("n"), ["conv_id", "block"])
    placed = placed.withColumn("at", F.col("id") - F.col("first"))
    own = placed.where(F.col("at") >= F.col("h")).withColumn("at", F.col("at") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "at", "a", "b", "letters", F.col("length").alias("n")]
    turns = own.select(*columns)
    if heads is not None:
        # No base has more than `group` followers or gives more than `turns` turns.
        given = placed.where((F.col("at") < heads.turns - 1) & (F.col("conv_id") % heads.group == 0))
        given = given.select(F.col("conv_id").alias("base"), "at", "a", "b", "letters")
        followers = plans.select("conv_id", "base", "h", "length").join(given, "base")
        turns = turns.unionByName(followers.where(F.col("at") < F.col("h")).select(*columns))
    first, second = _lanes(F.concat_ws(" ", "at", "a", "b"))
    turns = turns.select("conv_id", "at", "letters", "n", first.alias("own_p"), second.alias("own_q"))
    turns = staged(turns.withColumn("block", F.floor(F.col("at") / _BLOCK)), "hashed")

    inside = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = turns.where(F.col("n") > _BLOCK).groupBy("conv_id", "block")
    blocks = blocks.agg(F.bit_xor("own_p").alias("p"), F.bit_xor("own_q").alias("q"))
    blocks = blocks.select("conv_id", "block", *(F.coalesce(F.bit_xor(c).over(before), zero).alias(f"before_{c}") for c in "pq"))
    summed = turns.select("*", *(F.bit_xor(f"own_{c}").over(inside).alias(f"in_{c}") for c in "pq"))
    summed = summed.join(blocks, ["conv_id", "block"], "left")
    whole = [F.col(f"in_{c}").bitwiseXOR(F.coalesce(f"before_{c}", zero)).alias(c) for c in "pq"]
    keyed = summed.select("conv_id", (F.col("at") + 1).alias("depth"), *whole, "own_p", "own_q", "letters", "n")
    parent = [F.col(c).bitwiseXOR(F.col(f"own_{c}")).alias(f"up_{c}") for c in "pq"]
    paths = keyed.select("conv_id", *_KEY, *parent, "letters", "n")
    return staged(paths, "paths"), plans.select("conv_id", F.col("length").alias("n"))


def _nodes(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """All nodes with their parents and children; ``weight`` counts the turns of members beneath."""
    below = F.sum(F.col("n") - F.col("depth") + 1)
    nodes = paths.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("letters").alias("letters"),
        F.max("up_p").alias("up_p"),
        F.max("up_q").alias("up_q"),
        below.alias("weight"),
    )
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "p", "q")]
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("n") + 1).alias("weight"))
    root = root.where(F.col("n_convs") > 0).select(
        *zero, "conv_id", "n_convs", *(F.lit(0).cast("long").alias(c) for c in ("letters", "up_p", "up_q")), "weight"
    )
    nodes = staged(nodes.unionByName(root), "nodes")
    parents = [(F.col("depth") - 1).alias("depth"), F.col("up_p").alias("p"), F.col("up_q").alias("q")]
    children = nodes.where("depth > 0").groupBy(*parents).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = staged(nodes, "nodes")

    # What a node tells its children: not more than `_HEAVY` of them have so many.
    heavy = F.col("siblings") > max(1, nodes.count() // _HEAVY)
    told = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("p").alias("up_p"),
        F.col("q").alias("up_q"),
        F.col("conv_id").alias("parent_conv"),
        F.col("n_children").alias("siblings"),
    )
    lower = _joined(nodes.where("depth > 0"), told, ["depth", "up_p", "up_q"], heavy)
    top = nodes.where("depth = 0").withColumn("parent_conv", F.lit(None).cast("long"))
    kept = [*_KEY, "conv_id", "parent_conv", "n_convs", "n_children", "letters", "weight"]
    return staged(lower.select(*kept).unionByName(top.select(*kept)), "nodes")


def _end_sums(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """For nodes at which conversations end: the SHA-256 sum of their ids, joined by commas.

    Ids are put together in ranges of at most ``2 ** _CHUNK``; the ranges of a node go
    through one sum in their order, a few of them in memory at a time.
    """
    ends = paths.where(F.col("depth") == F.col("n")).select(*_KEY, "conv_id")
    zero = [F.lit(0).cast("long").alias(c) for c in _KEY]
    ends = ends.unionByName(lengths.where("n = 0").select(*zero, "conv_id"))
    ranges = ends.groupBy(*_KEY, F.shiftright("conv_id", _CHUNK).alias("chunk"))
    spelt = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    rows = ranges.agg(spelt.alias("ids")).withColumn("key", F.concat_ws(" ", *_KEY))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for batch in batches:
            done = []
            keys = zip(*(batch.column(c).to_pylist() for c in _KEY))
            for key, ids in zip(keys, batch.column("ids").to_pylist()):
                if key == last:
                    total.update(f",{ids}".encode())
                    continue
                if last is not None:
                    done.append((*last, total.hexdigest()))
                last, total = key, sha256(ids.encode())
            if done:
                yield _batch(done, [*_KEY, "ends_sha256"])
        if last is not None:
            yield _batch([(*last, total.hexdigest())], [*_KEY, "ends_sha256"])

    in_order = sorted_by(rows.drop("n"), "key", "chunk")
    return in_order.mapInArrow(add_up, "depth long, p long, q long, ends_sha256 string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)


def decompose(parents: list[int], tops: list[int], values: list[list[int]]) -> list[list[int]]:
    """Sums of ``values`` over the subtrees of a forest, by centroid decomposition.

    Nodes stand in an order in which parents come first; ``parents`` has -1 for a tree's
    top, and ``tops`` each node's top. ``values`` holds lists with a value for each node.
    """
    sums = [[0] * len(parents) for _ in values]
    trees: dict[int, list[int]] = {}
    for node, top in enumerate(tops):
        trees.setdefault(top, []).append(node)
    size, part = [0] * len(parents), [0] * len(parents)
    left = list(trees.values())
    while left:
        nodes = left.pop()
        top = nodes[0]
        for node in nodes:
            size[node] = 1
        for node in reversed(nodes):
            if node != top:
                size[parents[node]] += size[node]
        centre = next(n for n in reversed(nodes) if 2 * size[n] >= len(nodes))
        # The part of a node: the centroid's child above it, the centroid itself, or -1.
        pieces: dict[int, list[int]] = {}
        for node in nodes:
            if node == centre:
                part[node] = centre
                continue
            up = -1 if node == top else part[parents[node]]
            part[node] = node if up == centre else up
            pieces.setdefault(part[node], []).append(node)
        beneath = [centre, *(n for piece, ns in pieces.items() if piece != -1 for n in ns)]
        for value, total in zip(values, sums):
            held = sum(value[n] for n in beneath)
            node = centre
            total[node] += held
            while node != top:
                node = parents[node]
                total[node] += held
        left += pieces.values()
    return sums


_SUMS = ["leaves", "saved"]


def _decomposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the sums inside of whole components to those that their nodes have already."""
    for table in whole_groups(batches, "top"):
        table = table.sort_by([("depth", "ascending")])
        names = {c: table.column(c).to_pylist() for c in table.column_names}
        own = list(zip(names["conv_id"], names["depth"]))
        tops = list(zip(names["top_conv"], names["top_depth"]))
        place = {node: i for i, node in enumerate(own)}
        parents = [
            -1 if node == top else place[up, node[1] - 1]
            for node, top, up in zip(own, tops, names["parent_conv"])
        ]
        added = decompose(parents, [place[t] for t in tops], [names[c] for c in _SUMS])
        sums = [[a + b for a, b in zip(names[f"sum_{c}"], more)] for c, more in zip(_SUMS, added)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (names["conv_id"], names["depth"], *sums)],
            ["conv_id", "depth", *(f"sum_{c}" for c in _SUMS)],
        )


def _ancestors(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """For every conversation and depth: the node there, and the one above it."""
    heavy = F.col("n_convs") > max(1, paths.count() // _HEAVY)
    named = nodes.select(*_KEY, "n_convs", F.col("conv_id").alias("above"), F.col("parent_conv").alias("above_up"))
    found = _joined(paths.select("conv_id", *_KEY), named, _KEY, heavy)
    return staged(found.select("conv_id", F.col("depth").alias("at"), "above", "above_up"), "ancestors")


def _split(large: DataFrame, ancestors: DataFrame, total_nodes: int) -> tuple[DataFrame, DataFrame]:
    """Take the centroids out of components: what is left, and the centroids with their sums."""
    on_path = 2 * F.col("weight") >= F.col("total")
    deepest = F.max_by(F.struct("conv_id", "depth", "weight"), F.when(on_path, F.col("depth")))
    centres = large.groupBy(*_TOP).agg(deepest.alias("c")).select(
        *_TOP, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")
    )
    # As many rows as there are large components.
    rows = staged(large.join(F.broadcast(centres), _TOP), "centred")
    lower = F.col("depth") > F.col("c_depth")
    pairs = rows.where(lower).groupBy("conv_id", *_TOP, "c_conv", (F.col("c_depth") + 1).alias("at"))
    found = pairs.agg(F.count("*").alias("nodes")).join(ancestors, ["conv_id", "at"])
    found = found.where(F.col("above_up") == F.col("c_conv")).select("conv_id", *_TOP, "above", "nodes")
    found = staged(found, "beneath")
    heavy = F.col("nodes") > max(1, total_nodes // _HEAVY)
    marked = _joined(rows.where(lower), found, ["conv_id", *_TOP], heavy, "left").drop("nodes")
    upper = rows.where(~lower).withColumn("above", F.lit(None).cast("long"))
    rows = staged(marked.unionByName(upper.select(marked.columns)), "marked")

    is_centre = (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
    held = rows.where(is_centre | F.col("above").isNotNull()).groupBy(*_TOP)
    held = held.agg(*(F.sum(c).alias(f"held_{c}") for c in _SUMS))
    rows = rows.join(F.broadcast(held), _TOP).withColumn("on_path", on_path)
    for c in _SUMS:
        rows = rows.withColumn(f"sum_{c}", F.col(f"sum_{c}") + F.when(F.col("on_path"), F.col(f"held_{c}")).otherwise(0))
    rows = rows.withColumn("centre", is_centre)
    shrunk = F.col("weight") - F.when(F.col("on_path") & ~F.col("centre"), F.col("c_weight")).otherwise(0)
    moved = F.col("above").isNotNull()
    rows = rows.withColumns(
        {
            "weight": shrunk,
            "top_depth": F.when(moved, F.col("c_depth") + 1).otherwise(F.col("top_depth")),
            "top_conv": F.coalesce("above", "top_conv"),
        }
    )
    rows = staged(rows.drop("above", "on_path", "total", "c_conv", "c_depth", "c_weight", *(f"held_{c}" for c in _SUMS)), "split")
    return rows.where(~F.col("centre")).drop("centre"), rows.where("centre").drop("centre")


def _rolled_up(nodes: DataFrame, paths: DataFrame, rollup: Rollup) -> DataFrame:
    """``conv_id, depth`` of all nodes with the sums over their subtrees."""
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves")
    saved = ((F.col("n_convs") - 1) * F.col("letters")).alias("saved")
    zero = F.lit(0).cast("long")
    root = nodes.where("depth = 0").select("conv_id", "weight").first()
    top = [F.lit(root["conv_id"] if root else None).cast("long").alias("top_conv"), zero.alias("top_depth")]
    rows = nodes.select(
        "conv_id", "depth", "parent_conv", "weight", *top, leaf, saved, *(zero.alias(f"sum_{c}") for c in _SUMS)
    )
    number = nodes.count()
    limit = max(rollup.weight, -(-(root["weight"] if root else 0) // rollup.components))
    ancestors, small, done = None, [], []
    while True:
        totals = rows.groupBy(*_TOP).agg(F.max("weight").alias("total")).where(F.col("total") > limit)
        totals = staged(totals, "totals")
        if totals.isEmpty():
            small.append(rows)
            break
        if ancestors is None:
            ancestors = _ancestors(paths, nodes)
        # Their weights add up to the whole one at most, so there are few.
        small.append(rows.join(F.broadcast(totals), _TOP, "left_anti"))
        rows, centres = _split(rows.join(F.broadcast(totals), _TOP), ancestors, number)
        done.append(centres.select("conv_id", "depth", *(f"sum_{c}" for c in _SUMS)))
    for part in small:
        keyed = part.withColumn("top", F.concat_ws(" ", *_TOP))
        schema = "conv_id long, depth long, " + ", ".join(f"sum_{c} long" for c in _SUMS)
        done.append(sorted_by(keyed, "top").mapInArrow(_decomposed, schema))
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def prefix_trie(
    conversations: DataFrame, heads: Heads | None = None, rollup: Rollup = Rollup()
) -> DataFrame:
    """One row per node of the trie, with its members, children and sums over its subtree.

    ``conversations`` holds conv_id, turn, role and text. Turns are in the order of ``turn`` (NULL first), of
    role and of text; repeated rows are turns of their own. A NULL role or text is empty;
    turns without a conversation take no part. Other columns are left out. Without
    conversations there is no node, not even the root. With ``heads``, conversations are
    rebuilt first; one that has no turns then belongs to the root.
    """
    paths, lengths = _paths(conversations, heads)
    nodes = _nodes(paths, lengths)
    sums = _rolled_up(nodes, paths, rollup)
    told = nodes.join(_end_sums(paths, lengths), _KEY, "left").join(sums, ["conv_id", "depth"])
    return told.select(
        "conv_id",
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("sum_leaves").alias("n_leaves"),
        F.col("sum_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
    )
