"""Near-duplicate vectors through a robust-pruned flat graph.

Vectors go to the shards of their nearest centres, several each, so shards overlap. Each
shard builds a graph in which a vector keeps a neighbour only if no neighbour kept before
is clearly nearer to it. The adjacency lists of all shards are united, and every vector is
searched for in the united graph of its shards: greedily from the shard's medoid, then on
through everything within the range. What is found is verified by its exact cosine. A
sample is compared with all vectors; if too few of its links were found, the shards
overlap more and the search goes on longer, until in the end everything meets.

Equal vectors are one node with a number of copies. A shard above a size is dealt into
blocks, and every two blocks are a task. A pair counts in the first shard it shares, and a
task returns numbers of links and a spanning forest, so pairs are never rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from folia.llm.components import components
from folia.llm.frames import staged, usable_vectors
from folia.operators.ids import with_dense_ids


@dataclass(frozen=True)
class FlatGraph:
    similarity: float = 0.95
    overlap: int = 2
    degree: int = 24
    alpha: float = 1.2
    # Nodes expanded on the way from the medoid, and how far below the similarity the
    # search still goes on.
    steps: int = 24
    slack: float = 0.04
    block: int = 1000
    # Centres are fitted on at most this many vectors, and there are at most so many.
    sample: int = 20_000
    centres: int = 4096
    # Vectors compared with all others at first; as many more are drawn as it takes to have
    # so many with links, of whom one class of larger link numbers makes up at most half.
    audited: int = 300
    linked: int = 100
    # The share of links to be found, in each class.
    recall: float = 0.97
    # Vectors that all others are compared with in one scan.
    scanned: int = 8192
    seed: int = 42


def unit_rows(vectors) -> np.ndarray:
    rows = np.array(list(vectors), dtype=np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def bounded_sample(frame: DataFrame, key: str, total: int, most: int, seed: int) -> pd.DataFrame:
    """About ``most`` rows by a keyed hash of their key, never more than twice that."""
    draw = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 31)) / float(1 << 31)
    share = min(1.0, most / max(total, 1))
    chosen = frame if share == 1.0 else frame.where(draw < share)
    return chosen.limit(2 * most).toPandas().sort_values(key, ignore_index=True)


def k_means(rows: np.ndarray, k: int, rounds: int, random: np.random.Generator) -> np.ndarray:
    """Centres of rows by Lloyd's rounds; centres without rows stay where they were."""
    centres = rows[random.choice(len(rows), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = (rows @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        counts = np.bincount(nearest, minlength=k)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _assigned(nodes: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """``id, shards``: the nearest centres of each node."""
    shared = nodes.sparkSession.sparkContext.broadcast(centres)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            near = unit_rows(frame["embedding"]) @ shared.value.T
            best = np.argsort(-near, axis=1, kind="stable")[:, :overlap]
            yield pd.DataFrame(
                {
                    "id": frame["id"],
                    "shards": list(best.astype(np.int32)),
                    "copies": frame["copies"],
                    "embedding": frame["embedding"],
                }
            )

    schema = "id long, shards array<int>, copies long, embedding array<float>"
    return nodes.select("id", "copies", "embedding").mapInPandas(assign, schema)


def _tasks(assigned: DataFrame, block: int) -> DataFrame:
    """A row for each node and pair of blocks it belongs to."""
    rows = assigned.withColumn("shard", F.explode("shards"))
    sizes = rows.groupBy("shard").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    # One row per centre: bounded.
    rows = rows.join(F.broadcast(sizes), "shard")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(
        "shard",
        F.least("own", "other").alias("a"),
        F.greatest("own", "other").alias("b"),
        "own",
        "id",
        "copies",
        "shards",
        "embedding",
    )


def pruned_graph(near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Adjacency of the robust-pruned graph, for all nodes at once.

    Each node takes its nearest remaining candidate, and those candidates go that are
    nearer to it, by a factor, than to the node. Links hold both ways.
    """
    distance = np.maximum(2 - 2 * near, 0)
    left = ~np.eye(len(near), dtype=bool)
    linked = np.zeros_like(left)
    rows = np.arange(len(near))
    for _ in range(min(degree, len(near) - 1)):
        best = np.where(left, distance, np.inf).argmin(axis=1)
        open_ = left[rows, best]
        if not open_.any():
            break
        linked[rows[open_], best[open_]] = True
        left &= alpha * distance[best] > distance
        left[rows, best] = False
    return linked | linked.T


def found_in_range(near: np.ndarray, linked: np.ndarray, graph: FlatGraph) -> np.ndarray:
    """Which nodes the search for each node finds in range; all searches go step by step."""
    n = len(near)
    medoid = int(near.sum(axis=1).argmax())
    seen = np.zeros((n, n), bool)
    seen[:, medoid] = True
    done = np.zeros_like(seen)
    rows = np.arange(n)
    for _ in range(min(graph.steps, n)):
        waiting = np.where(seen & ~done, near, -np.inf)
        best = waiting.argmax(axis=1)
        going = np.isfinite(waiting[rows, best])
        if not going.any():
            break
        done[rows[going], best[going]] = True
        seen[going] |= linked[best[going]]
    reach = linked.astype(np.float32)
    while True:
        border = seen & ~done & (near >= graph.similarity - graph.slack)
        if not border.any():
            break
        done |= border
        seen |= (border.astype(np.float32) @ reach) > 0
    inside = seen & (near >= graph.similarity)
    inside |= inside.T
    np.fill_diagonal(inside, False)
    return inside


def _forest(linked: np.ndarray) -> np.ndarray:
    """The smallest member that links lead to, for each member."""
    root = np.arange(len(linked))
    while True:
        lowest = np.where(linked, root[None, :], len(root)).min(axis=1)
        after = np.minimum(root, lowest)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _search_round(nodes: DataFrame, centres: np.ndarray, graph: FlatGraph) -> DataFrame:
    """``id, links, root`` of the nodes that have links, several rows each."""
    tasks = staged(_tasks(_assigned(nodes, centres, graph.overlap), graph.block), "tasks")
    names = ["shard", "a", "b"]

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        units = unit_rows(frame["embedding"])
        linked = pruned_graph(units @ units.T, graph.degree, graph.alpha)
        ids = frame["id"].to_numpy()
        return pd.DataFrame({"id": ids, "near": [ids[row] for row in linked]})

    lists = tasks.groupBy(*names).applyInPandas(build, "id long, near array<long>")
    united = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    joined = tasks.join(united, "id")

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", ignore_index=True)
        units, ids = unit_rows(frame["embedding"]), frame["id"].to_numpy()
        linked = np.zeros((len(ids), len(ids)), bool)
        for i, near in enumerate(frame["near"]):
            at = np.searchsorted(ids, near)
            at[at == len(ids)] = 0
            linked[i, at[ids[at] == near]] = True
        linked |= linked.T
        inside = found_in_range(units @ units.T, linked, graph)
        if frame["a"].iloc[0] != frame["b"].iloc[0]:
            own = frame["own"].to_numpy()
            inside &= own[:, None] != own[None, :]
        # Pairs that meet in a shard before this one are counted there.
        shards = np.array(frame["shards"].tolist())
        shard = int(frame["shard"].iloc[0])
        for i, j in ((i, j) for i in range(shards.shape[1]) for j in range(shards.shape[1])):
            one, other = shards[:, i], shards[:, j]
            earlier = np.where(one < shard, one, -1)
            inside &= ~(earlier[:, None] == other[None, :])
        root = _forest(inside)
        links = inside @ frame["copies"].to_numpy()
        out = pd.DataFrame({"id": ids, "links": links, "root": ids[root]})
        return out[out["links"] > 0]

    return joined.groupBy(*names).applyInPandas(search, "id long, links long, root long")


def _drawn(nodes: DataFrame, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``id, copies`` and unit vectors of a range of ids, which are in the order of hashes."""
    rows = nodes.select("id", "copies", "embedding").where(F.col("id").between(start, stop - 1)).toPandas()
    rows = rows.sort_values("id", ignore_index=True)
    return rows["id"].to_numpy(), rows["copies"].to_numpy(), unit_rows(rows["embedding"])


def _true_links(nodes: DataFrame, start: int, stop: int, similarity: float) -> dict[int, int]:
    """The number of links of nodes compared with all nodes, other copies left out."""
    own_ids, _, own_rows = _drawn(nodes, start, stop)
    queries = nodes.sparkSession.sparkContext.broadcast((own_ids, own_rows))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, rows = queries.value
        links = np.zeros(len(ids), np.int64)
        for frame in frames:
            for at in range(0, len(frame), 1024):
                part = frame.iloc[at : at + 1024]
                near = rows @ unit_rows(part["embedding"]).T >= similarity
                near &= ids[:, None] != part["id"].to_numpy()[None, :]
                links += near @ part["copies"].to_numpy()
        some = links > 0
        yield pd.DataFrame({"id": ids[some], "links": links[some]})

    # One row per partition and drawn node with links.
    counted = nodes.select("id", "copies", "embedding").mapInPandas(compare, "id long, links long")
    found = {r["id"]: r["links"] for r in counted.groupBy("id").agg(F.sum("links").alias("links")).collect()}
    queries.unpersist()
    return found


def link_class(links: int) -> int:
    """Numbers of links by powers of four."""
    return (links.bit_length() - 1) // 2


def _audit(nodes: DataFrame, total: int, graph: FlatGraph) -> tuple[dict[int, int], bool]:
    """The true numbers of links of drawn nodes that have any, and whether these are enough.

    Ids follow hashes of the vectors, so any range of them is a draw by chance. Further
    nodes are drawn until enough have links, or there are no more. A class of larger link
    numbers counts for half at most: a crowd does not hide pairs.
    """
    truth: dict[int, int] = {}
    start, size = 0, graph.audited
    while start < total:
        stop = min(total, start + size)
        truth |= _true_links(nodes, start, stop, graph.similarity)
        classes = np.bincount([link_class(n) for n in truth.values()], minlength=1)
        enough = classes[0] + np.minimum(classes[1:], graph.linked // 2).sum() >= graph.linked
        if enough:
            return truth, True
        start, size = stop, min(2 * size, graph.scanned)
    return truth, False


def audited_recall(truth: dict[int, int], own: dict[int, int]) -> float:
    """The lowest mean share of links found in a class; small classes join the next."""
    shares: list[float] = []
    means: list[float] = []
    at = None
    for i in sorted(truth, key=lambda i: truth[i]):
        if link_class(truth[i]) != at and len(shares) >= 10:
            means.append(float(np.mean(shares)))
            shares = []
        at = link_class(truth[i])
        shares.append(own.get(i, 0) / truth[i])
    return min([*means, float(np.mean(shares))])


def _exact_pass(nodes: DataFrame, total: int, graph: FlatGraph) -> DataFrame:
    """``id, links, root`` of all links: each block of nodes meets all nodes in a scan."""
    rounds = []
    for start in range(0, total, graph.scanned):
        block = nodes.sparkSession.sparkContext.broadcast(_drawn(nodes, start, min(total, start + graph.scanned)))

        def meet(frames: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            ids, copies, rows = block.value
            for frame in frames:
                for at in range(0, len(frame), 1024):
                    part = frame.iloc[at : at + 1024]
                    own = part["id"].to_numpy()
                    near = unit_rows(part["embedding"]) @ rows.T >= graph.similarity
                    near &= own[:, None] != ids[None, :]
                    hit, met = near.any(axis=1), near.any(axis=0)
                    if not hit.any():
                        continue
                    own, near = own[hit], near[np.ix_(hit, met)]
                    # A spanning forest: labels of block members go to and fro until they stay.
                    label = np.arange(near.shape[1])
                    while True:
                        low = np.where(near, label[None, :], len(label)).min(axis=1)
                        after = np.minimum(label, np.where(near, low[:, None], len(label)).min(axis=0))
                        if (after == label).all():
                            break
                        label = after
                    inside = ids[met]
                    yield pd.DataFrame(
                        {
                            "id": np.concatenate([own, inside]),
                            "links": np.concatenate([near @ copies[met], np.zeros(len(inside), np.int64)]),
                            "root": np.concatenate([inside[low], inside[label]]),
                        }
                    )

        made = nodes.select("id", "copies", "embedding").mapInPandas(meet, "id long, links long, root long")
        rounds.append(staged(made, "exact-links"))
    return reduce(DataFrame.unionAll, rounds)


def _links_of(found: DataFrame) -> DataFrame:
    return staged(found.groupBy("id").agg(F.sum("links").alias("links")), "counted")


def near_duplicates(vectors: DataFrame, graph: FlatGraph = FlatGraph()) -> DataFrame:
    """Link vectors with a cosine of at least ``similarity``, in double precision.

    Returns one row per vector: ``vec_id, n_links, component_id, kept, audited_recall``.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    that links lead to. NULL and zero vectors and such with NULL or non-finite numbers are
    linked with nothing and kept; repeated rows are links of each other. ``audited_recall``
    is the lowest of the audited classes, or 1 after comparing all with all. Vectors of other
    lengths than most fail. An empty table gives no rows; other columns are left out.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    usable = rows.where(usable_vectors())
    hashes = [F.xxhash64(F.lit(k), "embedding").alias(f"h{k}") for k in (1, 2)]
    hashed = usable.select("vec_id", "embedding", *hashes)
    distinct = hashed.groupBy("h1", "h2").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("smallest"), F.first("embedding").alias("embedding")
    )
    nodes = staged(with_dense_ids(distinct, ["h1", "h2"], 0), "nodes")
    total = nodes.count()
    nothing = F.lit(0).cast("long")
    if not total:
        return rows.select(
            "vec_id", nothing.alias("n_links"), F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"), F.lit(1.0).alias("audited_recall"),
        )
    truth, enough = _audit(nodes, total, graph)
    sample = bounded_sample(nodes.select("id", "embedding"), "id", total, graph.sample, graph.seed)
    points = unit_rows(sample["embedding"])
    random = np.random.default_rng(graph.seed)
    # A third of a block on average, so that few shards are dealt into blocks.
    wanted = -(-total * graph.overlap * 3 // graph.block)
    k = max(1, min(wanted, graph.centres, -(-len(points) // 8)))
    # Centres of one length: a longer one would draw vectors from everywhere.
    centres = unit_rows(k_means(points, k, 6, random))
    recall = None
    while enough:
        graph = replace(graph, overlap=min(graph.overlap, k))
        found = staged(_search_round(nodes, centres, graph), "node-links")
        counted = _links_of(found)
        # A bounded number of drawn nodes.
        own = {r["id"]: r["links"] for r in counted.where(F.col("id").isin(list(truth))).collect()}
        recall = audited_recall(truth, own)
        if recall >= graph.recall or graph.overlap == k:
            break
        graph = replace(graph, overlap=2 * graph.overlap, steps=2 * graph.steps)
    if recall is None or recall < graph.recall:
        # Without an audit, or with links still missing, nothing less tells all links.
        found, recall = _exact_pass(nodes, total, graph), 1.0
        counted = _links_of(found)
    grouped = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    joined = (
        nodes.select("id", "h1", "h2", "copies", "smallest")
        .join(counted, "id", "left")
        .join(grouped.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    joined = staged(joined, "node-classes")
    lowest = joined.groupBy("component").agg(F.min("smallest").alias("component_id"))
    classes = joined.join(lowest, "component").select(
        "h1", "h2", "component_id", (F.col("copies") - 1 + F.coalesce("links", nothing)).alias("n_links")
    )
    marked = rows.select(
        "vec_id", *(F.when(usable_vectors(), h).alias(f"h{k}") for k, h in zip((1, 2), hashes))
    )
    return marked.join(classes, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("n_links", nothing).alias("n_links"),
        F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("h1").isNull() | F.col("vec_id").eqNullSafe(F.col("component_id"))).alias("kept"),
        F.lit(recall).alias("audited_recall"),
    )
