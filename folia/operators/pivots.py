"""Exact search for many queries that leaves out what cannot hold a hit.

Pivots are vectors of the table drawn by a hash of their ids. Every vector is in the cell of its nearest
pivot, and the vectors of a cell are packed into blocks in the order of their angle to it. A block
knows the smallest and the largest angle of its vectors to every pivot. Angles are a metric: a vector's
angle to a query is at least the difference of their angles to any pivot. So a block, and a whole
cell, has a largest cosine that it can offer a query.

A search first compares every query with the cells nearest to it that hold enough vectors. Its
k-th best cosine is then a bar: the query goes on only to cells that can offer as much, and there only
to blocks that can. Nothing that is left out could be a hit, so results are those of
:func:`folia.operators.search.search_many`. How much is left out depends on the vectors: clusters
save most comparisons, vectors without any save none.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from folia.operators.search import _best_positions, best_first, search_many
from folia.session import materialise

# Cosines closer than this may tie once they are rounded.
_SLACK = 2e-9
# Queries that meet a block together, and blocks of a cell that meet them in a task.
_QUERIES = 128
_BLOCKS = 512


@dataclass(frozen=True)
class Pivots:
    """``cells``: pivots at most, of which there is one for ``per_cell`` vectors.

    ``block``: vectors that are compared, or left out, together. The summary of the cells has
    ``cells`` squared numbers, whatever the table's size.
    """

    cells: int = 512
    per_cell: int = 2000
    block: int = 128


def _units(column: pa.Array) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = rows.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def _offers(angles: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest cosine of queries with what lies between ``low`` and ``high`` of the pivots."""
    apart = np.zeros((len(angles), len(low)))
    # An empty cell is infinitely far.
    for pivot in range(angles.shape[1]):
        own = angles[:, pivot : pivot + 1]
        np.maximum(apart, np.maximum(low[:, pivot] - own, own - high[:, pivot]), out=apart)
    return np.cos(np.minimum(apart, np.pi)) + _SLACK


def _usable(frame: DataFrame, key: str) -> DataFrame:
    return frame.where(F.exists("embedding", lambda x: x != 0)).select(key, "embedding")


def _drawn(vectors: DataFrame, number: int, count: int) -> np.ndarray:
    """About ``number`` unit vectors, drawn by a hash of their ids; at least one."""
    order = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 40))
    drawn = vectors.where(order < int(min(1.0, number / count) * (1 << 40))).select("embedding").limit(2 * number)
    rows = drawn.toArrow()
    if not rows.num_rows:
        rows = vectors.select("embedding").limit(1).toArrow()
    return np.unique(_units(rows.column("embedding").combine_chunks()), axis=0)


def _blocks(vectors: DataFrame, pivots: np.ndarray, size: int) -> DataFrame:
    """Rows of up to ``size`` vectors of a cell: ids, unit rows, and their angles to all pivots."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosines = _units(batch.column("embedding")) @ shared.value.T
            cells = cosines.argmax(axis=1) if batch.num_rows else np.zeros(0, int)
            angle = _angles(cosines[np.arange(len(cells)), cells])
            batch = batch.append_column("cell", pa.array(cells.astype(np.int32)))
            yield batch.append_column("angle", pa.array(angle))

    more = [T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())]
    assigned = vectors.mapInArrow(assign, T.StructType([*vectors.schema.fields, *more]))
    # Ranges of (cell, angle): a large cell is dealt to several tasks.
    placed = assigned.repartitionByRange("cell", "angle", "id").sortWithinPartitions("cell", "angle")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            edges = np.flatnonzero(np.diff(cells, prepend=-1, append=-1)).tolist()
            for start, stop in zip(edges, edges[1:]):
                for first in range(start, stop, size):
                    part = batch.slice(first, min(size, stop - first))
                    units = _units(part.column("embedding"))
                    angles = _angles(units @ shared.value.T)
                    values = [
                        [int(cells[start])], [part.column("id").to_pylist()], [units.astype("<f8").tobytes()],
                        [angles.min(axis=0).tolist()], [angles.max(axis=0).tolist()],
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], schema.names)

    schema = T.StructType(
        [
            T.StructField("cell", T.IntegerType()),
            T.StructField("ids", T.ArrayType(vectors.schema["id"].dataType)),
            T.StructField("units", T.BinaryType()),
            T.StructField("low", T.ArrayType(T.DoubleType())),
            T.StructField("high", T.ArrayType(T.DoubleType())),
        ]
    )
    kinds = [to_arrow_type(field.dataType) for field in schema]
    return materialise(placed.select("cell", "id", "embedding").mapInArrow(pack, schema), "blocks")


def _cells(blocks: DataFrame, pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each cell the number of its vectors and its angles to the pivots; ``pivots`` squared numbers."""
    spread = blocks.select("cell", F.size("ids").alias("n"), F.posexplode(F.arrays_zip("low", "high")))
    edges = spread.groupBy("cell", "pos").agg(
        F.min("col.low").alias("low"), F.max("col.high").alias("high"), F.sum("n").alias("n")
    )
    table = edges.toArrow()
    cell, place = (table.column(c).to_numpy() for c in ("cell", "pos"))
    number = np.zeros(pivots, np.int64)
    low, high = np.full((pivots, pivots), np.inf), np.full((pivots, pivots), -np.inf)
    number[cell] = table.column("n").to_numpy()
    low[cell, place], high[cell, place] = (table.column(c).to_numpy() for c in ("low", "high"))
    return number, low, high


def search_by_pivots(
    vectors: DataFrame,
    queries: DataFrame,
    top_k: int = 10,
    settings: Pivots = Pivots(),
    compared: Accumulator | None = None,
) -> DataFrame:
    """The ``top_k`` of every query: ``query_id, rank, id, similarity``, as by comparing all with all.

    ``vectors`` needs ``id`` and ``embedding``, ``queries`` distinct ``query_id`` and ``embedding``.
    Zero vectors have the similarity NaN and come after all others, NULL vectors after them; for
    these to be hits there must be fewer than ``top_k`` others, and then all are compared, as for
    queries that are zero. NULL queries have no hits. ``compared`` counts pairs of vectors.
    """
    usable = _usable(vectors, "id")
    count = usable.count()
    present = queries.where(F.col("embedding").isNotNull()).select("query_id", "embedding")
    if count < top_k:
        return search_many(vectors.select("id", "embedding"), present, top_k)
    pivots = _drawn(usable, max(1, min(settings.cells, count // settings.per_cell)), count)
    blocks = _blocks(usable, pivots, settings.block)
    number, low, high = _cells(blocks, len(pivots))
    shared = usable.sparkSession.sparkContext.broadcast((pivots, number, low, high))
    asked = materialise(_usable(present, "query_id"), "asked")

    def nearest(rows: np.ndarray, bars: np.ndarray | None) -> list[list[int]]:
        """The nearest cells with enough vectors; with bars, the others that can offer as much."""
        pivots, number, low, high = shared.value
        cosines = rows @ pivots.T
        chosen = []
        offers = _offers(_angles(cosines), low, high) if bars is not None else cosines
        for row, (cosine, offer) in enumerate(zip(cosines, offers)):
            order = np.argsort(-cosine, kind="stable")
            enough = int(np.searchsorted(np.cumsum(number[order]), top_k)) + 1
            if bars is None:
                chosen.append(order[:enough].tolist())
            else:
                chosen.append([c for c in order[enough:].tolist() if offer[c] >= bars[row] and number[c]])
        return chosen

    first = _compared(blocks, _routed(asked, nearest, False), shared, top_k, vectors, queries, compared)
    hits = _ranked(first, top_k)
    # With one cell there is nothing further to ask for.
    if len(pivots) > 1:
        first = materialise(hits, "first")
        bars = first.where(F.col("rank") == top_k).select("query_id", F.col("similarity").alias("bar"))
        barred = asked.join(bars, "query_id")
        second = _compared(blocks, _routed(barred, nearest, True), shared, top_k, vectors, queries, compared)
        hits = _ranked(first.drop("rank").unionByName(second), top_k)
    zero = materialise(present.where(~F.exists("embedding", lambda x: x != 0)), "zero")
    if zero.isEmpty():
        return hits
    return hits.unionByName(search_many(vectors.select("id", "embedding"), zero, top_k))


def _ranked(hits: DataFrame, top_k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*best_first()))
    ranked = hits.select("query_id", rank.alias("rank"), "id", "similarity")
    return ranked.where(F.col("rank") <= top_k)


def _routed(asked: DataFrame, nearest, barred: bool) -> DataFrame:
    """Groups of queries for each cell that they go to."""
    name = asked.schema["query_id"].dataType.simpleString()

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                rows = np.array(frame["embedding"].tolist(), dtype=np.float64)
                rows /= np.sqrt((rows * rows).sum(axis=1, keepdims=True))
                cells = nearest(rows, frame["bar"].to_numpy() if barred else None)
                bars = frame["bar"] if barred else -2.0
                units = [r.tobytes() for r in rows]
                yield pd.DataFrame({"query_id": frame["query_id"], "unit": units, "bar": bars, "cells": cells})

    routed = asked.mapInPandas(route, f"query_id {name}, unit binary, bar double, cells array<int>")
    routed = materialise(routed.select("query_id", "unit", "bar", F.explode("cells").alias("cell")), "routed")
    # As many groups of a cell as its queries fill; one row per cell is counted.
    groups = routed.groupBy("cell").agg(F.ceil(F.count("*") / _QUERIES).cast("int").alias("groups"))
    dealt = routed.join(F.broadcast(groups), "cell")
    dealt = dealt.withColumn("group", F.pmod(F.xxhash64("query_id"), F.col("groups")))
    packed = F.collect_list(F.struct("query_id", "unit", "bar"))
    return dealt.groupBy("cell", "group").agg(packed.alias("asked")).drop("group")


def _compared(
    blocks: DataFrame,
    routed: DataFrame,
    shared,
    top_k: int,
    vectors: DataFrame,
    queries: DataFrame,
    compared: Accumulator | None,
) -> DataFrame:
    """The best of each block for each query whose bar it can reach."""
    query_type, id_type = queries.schema["query_id"], vectors.schema["id"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        pivots = shared.value[0]
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row].values.to_numpy()
                units = np.frombuffer(batch.column("units")[row].as_buffer(), "<f8").reshape(len(ids), -1)
                low, high = (np.array(batch.column(c)[row].as_py())[None, :] for c in ("low", "high"))
                group = batch.column("asked")[row].as_py()
                rows = np.stack([np.frombuffer(q["unit"], "<f8") for q in group])
                # What the task has found of a query raises its bar.
                bars = np.array([max(q["bar"], best[q["query_id"]][2] if q["query_id"] in best else -2.0) for q in group])
                open_ones = np.flatnonzero(_offers(_angles(rows @ pivots.T), low, high)[:, 0] >= bars)
                if compared is not None:
                    compared.add(len(open_ones) * len(ids))
                for query, scores in zip(open_ones.tolist(), rows[open_ones] @ units.T):
                    name = group[query]["query_id"]
                    near = _best_positions(scores, ids, top_k)
                    found_ids, found = ids[near], scores[near]
                    if name in best:
                        found_ids = np.concatenate([best[name][0], found_ids])
                        found = np.concatenate([best[name][1], found])
                        near = _best_positions(found, found_ids, top_k)
                        found_ids, found = found_ids[near], found[near]
                    best[name] = found_ids, found, found[-1] if len(found) == top_k else -2.0
        for name, (ids, scores, _) in best.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(ids), type=to_arrow_type(query_type.dataType)),
                    pa.array(ids, type=to_arrow_type(id_type.dataType)),
                    pa.array(scores),
                ],
                names=["query_id", "id", "similarity"],
            )

    output = T.StructType([query_type, id_type, T.StructField("similarity", T.DoubleType())])
    # A query's vector is in the group of every cell it goes to. The files hold it once, so their size
    # says nothing of the groups, which must not be gathered in one place: both sides are shuffled.
    # Large cells are dealt to several tasks; one row per cell is counted.
    sizes = blocks.groupBy("cell").agg(F.ceil(F.count("*") / _BLOCKS).cast("int").alias("slices"))
    dealt = blocks.join(F.broadcast(sizes), "cell")
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64("ids"), F.col("slices")).cast("int")).drop("slices")
    groups = routed.join(F.broadcast(sizes), "cell")
    groups = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    return dealt.join(groups.hint("merge"), ["cell", "slice"]).drop("slice").mapInArrow(score, output)
