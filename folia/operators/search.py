"""Exact top-k search by cosine similarity.

Every task scores its Arrow batches with numpy and keeps only its own best k, so a
search is one scan without a shuffle of vectors; the tasks' winners are merged by a
top-k sort. Similarities that agree to nine decimals count as equal, the lower id
goes first; zero vectors (similarity NaN) come after all others, NULL vectors last.
"""

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from folia.session import materialise

# Decimals to which similarities are told apart.
PRECISION = 9
# Queries, and vectors, that are scored together.
_QUERY_BLOCK = 64
_VECTOR_BLOCK = 256

HIT_COLUMNS = ("id", "source", "filename", "chunk_index", "content", "metadata")


def best_first(similarity: str = "similarity", key: str = "id") -> list[Column]:
    score = F.col(similarity)
    return [
        F.isnull(score).asc(),
        F.isnan(score).asc(),
        F.round(score, PRECISION).desc(),
        F.col(key).asc(),
    ]


def vector_from_json(text: str) -> list[float]:
    """A query vector given as a JSON list."""
    return [float(x) for x in json.loads(text)]


def similarity_search(
    vectors: DataFrame,
    query: Sequence[float],
    top_k: int = 10,
    columns: Sequence[str] = HIT_COLUMNS,
) -> DataFrame:
    """The ``top_k`` most similar rows, with their ``similarity``.

    ``vectors`` needs ``id``, ``embedding`` and the columns to return.
    """
    target = np.asarray(query, dtype=np.float64)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[pa.RecordBatch] = []
        waiting = 0
        for batch in batches:
            scored = _with_similarity(batch, target)
            best.append(_top(scored, top_k))
            waiting += best[-1].num_rows
            # Merge now and then, so that a task holds a few times k rows at most.
            if waiting > 8 * top_k:
                best = [_top(_joined(best), top_k)]
                waiting = best[0].num_rows
        if best:
            yield _top(_joined(best), top_k)

    schema = T.StructType(
        [vectors.schema["id"], T.StructField("similarity", T.DoubleType())]
    )
    winners = vectors.select("id", "embedding").mapInArrow(score, schema)
    winners = winners.orderBy(*best_first()).limit(top_k)
    more = [name for name in dict.fromkeys(columns) if name != "id"]
    if not more:
        return winners.select(*columns, "similarity")
    # At most k rows, safe to broadcast; only their texts are passed on.
    found = vectors.select("id", *more).join(F.broadcast(winners), "id")
    return found.orderBy(*best_first()).limit(top_k).select(*columns, "similarity")


def search_many(vectors: DataFrame, queries: DataFrame, top_k: int = 10) -> DataFrame:
    """The ``top_k`` of every query: ``query_id, rank, id, similarity``.

    ``queries`` holds distinct ``query_id`` and ``embedding``. Both sides are packed into
    blocks of rows, and every block of queries meets every block of vectors in a task, so
    there is one plan for any number of queries. Spark sends the blocks of queries to all
    tasks if they are small enough. A task keeps the best k of each of its queries; Spark
    cuts these to k again before and after the shuffle.
    """
    query_type, id_type = queries.schema["query_id"], vectors.schema["id"]
    asked = materialise(_packed(queries, "query_id", _QUERY_BLOCK, "asked"), "queries")
    pairs = _packed(vectors, "id", _VECTOR_BLOCK, "stored").crossJoin(asked)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for batch in batches:
            for row in range(batch.num_rows):
                names = batch.column("asked_ids")[row].values.to_pylist()
                targets, ids = _block(batch, "asked", row), batch.column("stored_ids")[row].values.to_numpy()
                present = batch.column("stored_present")[row].values.to_numpy(zero_copy_only=False)
                scores = np.full((len(names), len(ids)), -np.inf)
                if present.any():
                    scores[:, present] = targets @ _block(batch, "stored", row).T
                for name, found in zip(names, scores):
                    near = _best_positions(found, ids, top_k)
                    known_ids, known = best.get(name, (ids[:0], found[:0]))
                    all_ids = np.concatenate([known_ids, ids[near]])
                    all_scores = np.concatenate([known, found[near]])
                    keep = _best_positions(all_scores, all_ids, top_k)
                    best[name] = (all_ids[keep], all_scores[keep])
        for name, (ids, scores) in best.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(ids), type=to_arrow_type(query_type.dataType)),
                    pa.array(ids, type=to_arrow_type(id_type.dataType)),
                    pa.array(scores, mask=np.isneginf(scores), from_pandas=False),
                ],
                names=["query_id", "id", "similarity"],
            )

    output = T.StructType([query_type, id_type, T.StructField("similarity", T.DoubleType())])
    found = pairs.mapInArrow(score, output)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*best_first()))
    ranked = found.select("query_id", rank.alias("rank"), "id", "similarity")
    return ranked.where(F.col("rank") <= top_k)


def _packed(frame: DataFrame, key: str, size: int, name: str) -> DataFrame:
    """Rows of up to ``size`` ids and their unit vectors as one matrix each."""
    schema = T.StructType(
        [
            T.StructField(f"{name}_ids", T.ArrayType(frame.schema[key].dataType)),
            T.StructField(f"{name}_present", T.ArrayType(T.BooleanType())),
            T.StructField(name, T.BinaryType()),
            T.StructField(f"{name}_dims", T.IntegerType()),
        ]
    )
    kinds = [to_arrow_type(field.dataType) for field in schema]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                rows, present = _matrix(part.column("embedding"))
                there = np.zeros(part.num_rows, bool)
                there[present] = True
                unit = _unit_rows(rows).astype("<f8")
                values = [part.column(key).to_pylist()], [there.tolist()], [unit.tobytes()], [unit.shape[1]]
                arrays = [pa.array(v, kind) for v, kind in zip(values, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return frame.select(key, "embedding").mapInArrow(pack, schema)


def _block(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    raw = np.frombuffer(batch.column(name)[row].as_buffer(), "<f8")
    return raw.reshape(-1, max(1, batch.column(f"{name}_dims")[row].as_py()))


def report(hits: DataFrame) -> DataFrame:
    """Hits as printed: rank, similarity to three decimals, a one-line preview."""
    # The hits of one search are at most k rows; more would not be printed.
    rank = F.row_number().over(Window.orderBy(*best_first()))
    preview = F.translate(F.substring("content", 1, 200), "\n", " ")
    return hits.select(
        rank.alias("rank"),
        F.format_number("similarity", 3).alias("score"),
        F.concat("filename", F.lit("#chunk-"), "chunk_index").alias("chunk"),
        "source",
        F.when(F.length("content") > 200, F.concat(preview, F.lit("...")))
        .otherwise(preview)
        .alias("preview"),
    )


def _matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The vectors that are not NULL as a matrix, and where they are."""
    present = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(present), -1) if len(present) else np.zeros((0, 0)), present


def _unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows become NaN."""
    if rows.size == 0:
        return rows
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _with_similarity(batch: pa.RecordBatch, target: np.ndarray) -> pa.RecordBatch:
    rows, present = _matrix(batch.column("embedding"))
    similarity = np.zeros(batch.num_rows)
    if len(present):
        with np.errstate(invalid="ignore", divide="ignore"):
            lengths = np.sqrt((rows * rows).sum(axis=1) * (target * target).sum())
            similarity[present] = (rows * target).sum(axis=1) / lengths
    missing = np.ones(batch.num_rows, dtype=bool)
    missing[present] = False
    kept = [i for i, name in enumerate(batch.schema.names) if name != "embedding"]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(i) for i in kept), pa.array(similarity, mask=missing, from_pandas=False)],
        names=[*(batch.schema.names[i] for i in kept), "similarity"],
    )


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    return table.to_batches()[0] if table.num_rows else batches[0]


def _top(batch: pa.RecordBatch, top_k: int) -> pa.RecordBatch:
    similarity = batch.column("similarity")
    scores = similarity.to_numpy(zero_copy_only=False).copy()
    scores[similarity.is_null().to_numpy(zero_copy_only=False)] = -np.inf
    return batch.take(pa.array(_best_positions(scores, batch.column("id").to_numpy(), top_k)))


def _best_positions(scores: np.ndarray, ids: np.ndarray, top_k: int) -> np.ndarray:
    """Positions of the best ``top_k``, best first; -inf stands for NULL."""
    keys = np.where(np.isnan(scores), -1e300, np.round(scores, PRECISION))
    positions = np.arange(len(keys))
    if len(keys) > top_k:
        # All that tie with the last one to keep stay in until the ids decide.
        last = -np.partition(-keys, top_k - 1)[top_k - 1]
        positions = np.flatnonzero(keys >= last)
    return positions[np.lexsort((ids[positions], -keys[positions]))][:top_k]
