"""Nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree splits a sample into clusters of clusters; every vector goes down to the leaf of
its nearest centres. A query visits leaves in the order in which a priority queue yields
them: it holds the nodes seen so far, the most promising first, and a node taken from it
puts its children in. How many leaves are visited is calibrated: for sample queries the
true neighbours among all vectors are known, and visits are widened until the leaves
visited hold the wanted share of them.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from folia.llm.flatgraph import bounded_sample, k_means
from folia.llm.frames import staged, usable_vectors


@dataclass(frozen=True)
class TreeSearch:
    k: int = 20
    recall: float = 0.95
    branching: int = 8
    # Sampled vectors in a leaf at most; the sample is bounded, and so are the leaves.
    leaf: int = 600
    sample: int = 20_000
    # Queries of the calibration.
    calibrated: int = 128
    # Vectors, and queries, that are compared at once.
    block: int = 2000
    seed: int = 42


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays; ``children[i]`` lists the nodes below i, ``leaf[i]`` its number or -1."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child, from the root down."""
        node = np.zeros(len(rows), np.int64)
        while True:
            inner = np.flatnonzero(self.leaf[node] < 0)
            if not len(inner):
                return self.leaf[node]
            for own in np.unique(node[inner]):
                at = inner[node[inner] == own]
                below = self.centres[self.children[own]]
                near = rows[at] @ below.T - 0.5 * (below**2).sum(axis=1)
                node[at] = np.array(self.children[own])[near.argmax(axis=1)]

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first leaves that the priority queue yields for a query."""
        promise = self.centres @ query
        queue, found = [(-promise[0], 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                found.append(int(self.leaf[node]))
            for child in self.children[node]:
                heapq.heappush(queue, (-promise[child], child))
        return found


def grow(rows: np.ndarray, branching: int, leaf: int, seed: int) -> Tree:
    """Split rows into clusters until they are small."""
    random = np.random.default_rng(seed)
    centres, children, leaves = [rows.mean(axis=0)], [[]], [-1]
    waiting, number = [(0, rows)], 0
    while waiting:
        node, own = waiting.pop()
        parts: list[np.ndarray] = []
        if len(own) > leaf:
            below = k_means(own, min(branching, len(own)), 8, random)
            nearest = (own @ below.T - 0.5 * (below**2).sum(axis=1)).argmax(axis=1)
            kept = [(below[c], own[nearest == c]) for c in range(len(below)) if (nearest == c).any()]
            parts = kept if len(kept) > 1 else []
        if not parts:
            leaves[node], number = number, number + 1
        for centre, inside in parts:
            children[node].append(len(centres))
            waiting.append((len(centres), inside))
            centres.append(centre)
            children.append([])
            leaves.append(-1)
    return Tree(np.array(centres), children, np.array(leaves))


def _matrix(vectors) -> np.ndarray:
    return np.array(list(vectors), dtype=np.float64)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Query rows and columns of the best k of each row, ties to the smaller id."""
    # Ids ascend along the columns, so a stable order of the scores breaks ties rightly.
    n = scores.shape[1]
    if n > 4 * k:
        border = np.partition(scores, n - k, axis=1)[:, n - k, None]
        rows, columns = np.nonzero(scores >= border)
    else:
        rows, columns = np.nonzero(np.isfinite(scores))
    order = np.lexsort((ids[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    first = np.searchsorted(rows, rows)
    best = (np.arange(len(rows)) - first < k) & np.isfinite(scores[rows, columns])
    return rows[best], columns[best]


def _placed(vectors: DataFrame, tree: Tree) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.assign(leaf=shared.value.place(_matrix(frame["embedding"])).astype(np.int32))

    return vectors.mapInPandas(place, "vec_id long, embedding array<double>, leaf int")


def _calibrate(placed: DataFrame, total: int, tree: Tree, search: TreeSearch) -> int:
    """Leaves to visit so that sample queries find the wanted share of their neighbours."""
    sample = bounded_sample(
        placed.select("vec_id", "embedding"), "vec_id", total, search.calibrated, search.seed + 1
    )
    sample = sample.dropna(subset=["vec_id"]).drop_duplicates("vec_id")
    if sample.empty:
        return tree.leaves
    ids, queries = sample["vec_id"].to_numpy(np.int64), _matrix(sample["embedding"])
    shared = placed.sparkSession.sparkContext.broadcast((ids, queries))

    def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, rows = shared.value
        best: list[pd.DataFrame] = []
        for frame in frames:
            for at in range(0, len(frame), search.block):
                part = frame.iloc[at : at + search.block].sort_values("vec_id", na_position="first")
                scores = rows @ _matrix(part["embedding"]).T
                names = part["vec_id"].fillna(-(1 << 62)).to_numpy(np.int64)
                scores[own[:, None] == names[None, :]] = -np.inf
                q, c = _top(scores, names, search.k)
                best.append(pd.DataFrame({"query": q, "score": scores[q, c], "vec_id": names[c], "leaf": part["leaf"].to_numpy()[c]}))
                if len(best) > 1:
                    merged = pd.concat(best).sort_values(["query", "score", "vec_id"], ascending=[True, False, True])
                    best = [merged.groupby("query").head(search.k)]
        if best:
            yield best[0]

    rows = placed.mapInPandas(nearest, "query long, score double, vec_id long, leaf int")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    truth = rows.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= search.k)
    # k rows for each of a bounded number of queries.
    truth = truth.select("query", "leaf").toPandas()
    order = [{leaf: i for i, leaf in enumerate(tree.visits(q, tree.leaves))} for q in queries]
    needed = np.sort([order[q][leaf] + 1 for q, leaf in zip(truth["query"], truth["leaf"])])
    return int(needed[min(len(needed) - 1, int(np.ceil(search.recall * len(needed))) - 1)]) if len(needed) else 1


def nearest_vectors(
    vectors: DataFrame, queries: Column, search: TreeSearch = TreeSearch()
) -> DataFrame:
    """The ``k`` vectors with the largest inner products found for each query row.

    ``queries`` tells which rows are queries; all other rows than the query's own are
    candidates. Returns ``query_id, rank, vec_id, score, leaves_visited``, scores in double
    precision on the original vectors, ties to the smaller id. NULL and zero vectors and
    such with NULL or non-finite numbers take no part; rows without an id are candidates
    only; with repeated ids, rows with the query's id count as its own, and each such row is
    found or asked once more. An empty table, or one without queries, gives no rows; other
    columns are left out.
    """
    rows = vectors.where(usable_vectors()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(queries, F.lit(False)).alias("_asked"),
    )
    usable = rows.select("vec_id", "embedding")
    total = usable.count()
    schema = "query_id long, rank int, vec_id long, score double, leaves_visited int"
    if not total:
        return vectors.sparkSession.createDataFrame([], schema)
    key = F.xxhash64("vec_id", "embedding")
    sample = bounded_sample(usable.withColumn("_key", key), "_key", total, search.sample, search.seed)
    tree = grow(_matrix(sample["embedding"]), search.branching, search.leaf, search.seed)
    placed = staged(_placed(usable, tree), "placed")
    visited = _calibrate(placed, total, tree, search)
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def visits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            # A query's vector is repeated for each leaf, so only some queries at a time.
            for at in range(0, len(frame), 128):
                part = frame.iloc[at : at + 128]
                leaves = [shared.value.visits(q, visited) for q in _matrix(part["embedding"])]
                yield part.assign(leaf=leaves).explode("leaf").astype({"leaf": "int32"})

    asked = rows.where("_asked").where(F.col("vec_id").isNotNull()).select("vec_id", "embedding").distinct()
    asking = staged(asked.mapInPandas(visits, "vec_id long, embedding array<double>, leaf int"), "visits")
    # Both sides of a leaf are dealt into blocks of a bounded size, every two of which meet.
    blocks = lambda frame, name: frame.groupBy("leaf").agg(F.ceil(F.count("*") / search.block).cast("int").alias(name))
    sizes = staged(blocks(placed, "_members").join(blocks(asking, "_queries"), "leaf"), "sizes")

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        # One row per leaf: bounded.
        frame = frame.join(F.broadcast(sizes), "leaf")
        block = F.pmod(F.xxhash64("vec_id", "embedding"), F.col(own)).cast("int")
        across = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return frame.withColumn(f"{own}_block", block).withColumn(f"{other}_block", across)

    names = ["leaf", "_members_block", "_queries_block"]
    left = dealt(placed, "_members", "_queries").select(*names, "vec_id", "embedding")
    right = dealt(asking, "_queries", "_members").select(*names, "vec_id", "embedding")

    def compare(members: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        if members.empty or group.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        members = members.sort_values("vec_id", na_position="first")
        missing = members["vec_id"].isna().to_numpy()
        ids = members["vec_id"].fillna(-(1 << 62)).to_numpy(np.int64)
        asked_ids = group["vec_id"].to_numpy(np.int64)
        scores = _matrix(group["embedding"]) @ _matrix(members["embedding"]).T
        scores[asked_ids[:, None] == ids[None, :]] = -np.inf
        q, c = _top(scores, ids, search.k)
        found = pd.Series(ids[c], dtype="Int64").mask(pd.Series(missing[c]))
        return pd.DataFrame({"query_id": asked_ids[q], "vec_id": found, "score": scores[q, c]})

    hits = (
        left.groupBy(*names)
        .cogroup(right.groupBy(*names))
        .applyInPandas(compare, "query_id long, vec_id long, score double")
    )
    # Limited per task before the shuffle, and again after it.
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"))
    ranked = hits.withColumn("rank", F.row_number().over(by).cast("int")).where(F.col("rank") <= search.k)
    return ranked.select("query_id", "rank", "vec_id", "score", F.lit(visited).alias("leaves_visited"))
