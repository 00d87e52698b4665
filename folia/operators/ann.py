"""Approximate search over inverted lists, kept up with appended vectors.

The centres of the lists are vectors of the table, drawn by a hash of their ids over all of
them. Every vector is stored once, in the folder of its nearest centre, and later
vectors are put into the lists by the same centres. A search reads the lists whose centres
are nearest to the query and ranks what is in them exactly. Zero and NULL vectors are in
no list.
"""

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from folia.operators.search import HIT_COLUMNS, _best_positions, best_first, similarity_search
from folia.session import materialise

# Folders below an index.
_CENTRES, _LISTS = "centres", "lists"
# Rows of a list, and queries, that meet in a task.
_ROWS, _QUERIES = 4000, 1000


def _usable(vectors: DataFrame) -> DataFrame:
    return vectors.where(F.exists("embedding", lambda x: x != 0)).select("id", "embedding")


def build_index(vectors: DataFrame, path: str, lists: int = 32) -> None:
    """Choose ``lists`` centres and store the vectors; the folder must be new.

    The centres are the vectors with the smallest MD5 sums of their ids.
    """
    order = F.md5(F.col("id").cast("string").cast("binary"))
    chosen = _usable(vectors).withColumn("_order", order).orderBy("_order", "id").limit(lists)
    chosen.write.mode("errorifexists").parquet(f"{path}/{_CENTRES}")
    add_to_index(vectors, path)


def _centres(spark: SparkSession, path: str) -> np.ndarray:
    """The centres as unit rows in their order; as many as there are lists."""
    rows = spark.read.parquet(f"{path}/{_CENTRES}").orderBy("_order", "id").select("embedding").collect()
    centres = np.array([r["embedding"] for r in rows], dtype=np.float64)
    return centres / np.linalg.norm(centres, axis=1, keepdims=True) if len(rows) else centres


def add_to_index(vectors: DataFrame, path: str) -> None:
    """Append vectors to the lists of their nearest centres."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(_centres(spark, path))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            rows = rows.reshape(batch.num_rows, -1)
            # The length of a row does not change which centre is nearest.
            nearest = (rows @ shared.value.T).argmax(axis=1) if batch.num_rows else np.zeros(0)
            yield batch.append_column("list", pa.array(nearest.astype(np.int32)))

    usable = _usable(vectors)
    schema = T.StructType([*usable.schema.fields, T.StructField("list", T.IntegerType())])
    assigned = usable.mapInArrow(assign, schema)
    # Long lists are written by several tasks.
    spread = assigned.repartition("list", F.pmod(F.xxhash64("id"), F.lit(8)))
    spread.write.mode("append").partitionBy("list").parquet(f"{path}/{_LISTS}")


def ann_search(
    vectors: DataFrame,
    path: str,
    query: Sequence[float],
    top_k: int = 10,
    probes: int = 12,
    columns: Sequence[str] = HIT_COLUMNS,
) -> DataFrame:
    """The most similar vectors of the ``probes`` lists nearest to the query.

    Where these hold fewer than ``top_k``, twice as many lists are searched, and so on until
    there are enough or all lists have been searched.
    """
    spark = vectors.sparkSession
    centres = _centres(spark, path)
    target = np.asarray(query, dtype=np.float64)
    order = np.argsort(-(centres @ target), kind="stable").tolist() if len(centres) else []
    stored = spark.read.parquet(f"{path}/{_LISTS}") if order else None
    hits: list = []
    while order:
        near = stored.where(F.col("list").isin(order[:probes])).select("id", "embedding")
        hits = similarity_search(near, query, top_k, ["id"]).collect()
        if len(hits) >= top_k or probes >= len(order):
            break
        probes *= 2
    found = [vectors.schema["id"], T.StructField("similarity", T.DoubleType())]
    # At most k rows.
    ranked = spark.createDataFrame(hits, T.StructType(found))
    payload = vectors.where(F.col("id").isin([h["id"] for h in hits]))
    payload = payload.select(*dict.fromkeys(["id", *columns]))
    joined = payload.join(F.broadcast(ranked), "id")
    return joined.orderBy(*best_first()).select(*columns, "similarity")


def ann_search_many(
    spark: SparkSession, path: str, queries: DataFrame, top_k: int = 10, probes: int = 12
) -> DataFrame:
    """The ``top_k`` of every query in the lists it probes: ``query_id, rank, id, similarity``.

    ``queries`` holds distinct ``query_id`` and ``embedding``; zero and NULL queries have no
    hits. Blocks of queries meet blocks of the lists. Queries with fewer than ``top_k`` hits
    are asked again with twice as many lists.
    """
    centres = _centres(spark, path)
    usable = queries.where(F.exists("embedding", lambda x: x != 0)).select("query_id", "embedding")
    left, answered = materialise(usable, "ann-queries"), []
    query_type = queries.schema["query_id"].dataType.simpleString()
    if not len(centres):
        return spark.createDataFrame([], f"query_id {query_type}, rank int, id long, similarity double")
    stored = spark.read.parquet(f"{path}/{_LISTS}")
    id_type = stored.schema["id"].dataType.simpleString()
    # One row per list.
    sizes = stored.groupBy("list").agg(F.ceil(F.count("*") / _ROWS).cast("int").alias("blocks"))
    sizes = materialise(sizes, "ann-sizes")
    shared = spark.sparkContext.broadcast(centres)

    def score(stored: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(stored) and len(asked):
            rows = np.array(stored["embedding"].tolist(), dtype=np.float64)
            targets = np.array(asked["embedding"].tolist(), dtype=np.float64)
            rows /= np.linalg.norm(rows, axis=1, keepdims=True)
            targets /= np.linalg.norm(targets, axis=1, keepdims=True)
            ids = stored["id"].to_numpy()
            for name, found in zip(asked["query_id"], targets @ rows.T):
                near = _best_positions(found, ids, top_k)
                out.append(pd.DataFrame({"query_id": name, "id": ids[near], "similarity": found[near]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "similarity": []})

    while True:
        count, depth = left.count(), min(probes, len(centres))

        def probe(frames: Iterator[pd.DataFrame], depth=depth) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if len(frame):
                    near = np.array(frame["embedding"].tolist(), dtype=np.float64) @ shared.value.T
                    lists = np.argsort(-near, axis=1, kind="stable")[:, :depth].astype(np.int32)
                    yield frame.assign(lists=list(lists))

        asked = left.mapInPandas(probe, f"query_id {query_type}, embedding array<float>, lists array<int>")
        parts = max(1, -(-count * depth // (len(centres) * _QUERIES)))
        asked = asked.withColumn("list", F.explode("lists")).drop("lists").join(F.broadcast(sizes), "list")
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")).drop("blocks")
        dealt = stored.join(F.broadcast(sizes), "list")
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
        dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        keys = ["list", "block", "part"]
        met = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys))
        hits = met.applyInPandas(score, f"query_id {query_type}, id {id_type}, similarity double")
        best = Window.partitionBy("query_id").orderBy(F.round("similarity", 9).desc(), "id")
        hits = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_k)
        hits = materialise(hits.select("query_id", "rank", "id", "similarity"), "ann-hits")
        full = hits.where(F.col("rank") == top_k).select("query_id")
        if depth == len(centres):
            answered.append(hits)
            break
        answered.append(hits.join(full, "query_id", "left_semi"))
        left = materialise(left.join(full, "query_id", "left_anti"), "ann-queries")
        if left.isEmpty():
            break
        probes = 2 * depth
    return reduce(DataFrame.unionAll, answered)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``queries`` and the share of the exact hits that were ``found``."""
    hit = found.select("query_id", "id", F.lit(1).alias("hit"))
    joined = exact.select("query_id", "id").join(hit, ["query_id", "id"], "left")
    share = F.sum(F.coalesce("hit", F.lit(0))) / F.count("*")
    return joined.agg(F.count_distinct("query_id").alias("queries"), share.alias("recall"))
