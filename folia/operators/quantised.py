"""Approximate search over compressed codes, with exact similarities for the best of them.

Every vector is in the list of its nearest centre, as in :mod:`folia.operators.ann`, with a code
beside it: what is left after the centre is cut into parts, and each part is named by the nearest
of up to 256 entries of its codebook, one byte a part. A search adds up, for every code of the
lists it reads, table entries that hold the products of the query's parts with the codebooks. Only
for the best codes are the vectors read and compared exactly.

Centres and codebooks are trained on a sample of all rows drawn by a hash of their ids. How many
lists are read and how many vectors are compared is calibrated on vectors of the table, whose true
neighbours are found by comparing them with all others. Zero and NULL vectors are in no list.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from folia.functions.vectors import cosine_similarity
from folia.operators.search import HIT_COLUMNS, PRECISION, best_first, search_many
from folia.session import materialise

# Folders below an index.
_MODEL, _CALIBRATION, _VECTORS = "model", "calibration", "vectors"
# Codes, and queries, that meet in a step.
_CODES, _QUERIES = 4096, 128
# Range of the hash that draws samples.
_DRAWS = 1 << 40


@dataclass(frozen=True)
class Quantising:
    """``lists``: number of centres, by default one for ``per_list`` vectors of the table.

    ``parts``: bytes of a code. ``sample``: vectors that centres and codebooks are trained on, about;
    there is a centre for eight of them at most. ``queries``: about as many calibrate the
    search until ``recall`` of the best ``top_k`` is found; ``most``: vectors compared for each hit at most.
    """

    lists: int | None = None
    per_list: int = 1000
    parts: int = 16
    sample: int = 20_000
    rounds: int = 12
    queries: int = 200
    top_k: int = 10
    recall: float = 0.95
    most: int = 100


@dataclass(frozen=True)
class Codes:
    """Unit centres, and for each part of the dimensions its codebook."""

    centres: np.ndarray
    books: list[np.ndarray]

    @property
    def bounds(self) -> np.ndarray:
        return np.cumsum([0, *(b.shape[1] for b in self.books)])

    def parts(self, rows: np.ndarray) -> list[np.ndarray]:
        edges = self.bounds
        return [rows[:, a:b] for a, b in zip(edges, edges[1:])]

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list and the code of each row."""
        lists = (units @ self.centres.T).argmax(axis=1)
        rest = self.parts(units - self.centres[lists])
        return lists, np.stack([_nearest(r, b) for r, b in zip(rest, self.books)], axis=1).astype(np.uint8)

    def tables(self, units: np.ndarray) -> np.ndarray:
        """For every query and part the products with the codebook's entries."""
        tables = np.zeros((len(units), len(self.books), 256), np.float32)
        for part, (rows, book) in enumerate(zip(self.parts(units), self.books)):
            tables[:, part, : len(book)] = rows @ book.T
        return tables


@dataclass(frozen=True)
class Depth:
    """Lists that a search reads, and vectors it compares for ``top_k`` hits."""

    lists: int
    compared: int
    top_k: int
    recall: float


def _nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (rows @ book.T - (book * book).sum(axis=1) / 2).argmax(axis=1)


def _means(rows: np.ndarray, number: int, rounds: int, unit: bool) -> np.ndarray:
    """Centres by Lloyd's rounds, started from rows drawn with a fixed seed."""
    random = np.random.default_rng(7)
    centres = rows[random.permutation(len(rows))[:number]].copy()
    for _ in range(rounds if number > 1 else 1):
        # Blocks, so that the products stay small.
        near = np.concatenate([_nearest(rows[i : i + 4096], centres) for i in range(0, len(rows), 4096)])
        counts = np.bincount(near, minlength=len(centres))
        order = np.argsort(near, kind="stable")
        starts = np.flatnonzero(np.diff(near[order], prepend=-1))
        filled = np.flatnonzero(counts)
        centres[filled] = np.add.reduceat(rows[order], starts, axis=0) / counts[filled, None]
        if unit:
            lengths = np.linalg.norm(centres, axis=1, keepdims=True)
            centres /= np.where(lengths > 0, lengths, 1)
    return centres


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit rows of a column without NULLs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = rows.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _usable(vectors: DataFrame) -> DataFrame:
    usable = vectors.where(F.exists("embedding", lambda x: x != 0))
    return usable.select(F.col("id").cast("long").alias("id"), "embedding")


def _drawn(share: float, seed: int) -> Column:
    """True for about that share of the rows, drawn by their ids."""
    return F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(_DRAWS)) < int(min(1.0, share) * _DRAWS)


def _train(spark: SparkSession, sample: pa.Table, lists: int, settings: Quantising) -> Codes:
    """Centres on the driver, a codebook for each part in a task of its own."""
    units = _matrix(sample.column("embedding"))
    centres = _means(units, lists, settings.rounds, unit=True)
    rest = units - centres[(units @ centres.T).argmax(axis=1)]
    edges = [int(e) for e in np.linspace(0, units.shape[1], min(settings.parts, units.shape[1]) + 1)]
    shared = spark.sparkContext.broadcast(rest.astype(np.float32))
    rounds = settings.rounds

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in batch["id"]:
                own = shared.value[:, edges[part] : edges[part + 1]].astype(np.float64)
                book = _means(own, min(256, len(own)), rounds, unit=False)
                yield pd.DataFrame({"part": [part], "book": [book.astype("<f8").tobytes()]})

    parts = len(edges) - 1
    rows = spark.range(0, parts, 1, parts).mapInPandas(fit, "part long, book binary").collect()
    widths = np.diff(edges)
    books = [np.frombuffer(r["book"], "<f8").reshape(-1, widths[r["part"]]) for r in sorted(rows, key=lambda r: r["part"])]
    return Codes(centres, books)


def _save_model(spark: SparkSession, codes: Codes, path: str) -> None:
    kinds = "part int, rows int, width int, numbers binary"
    frames = [codes.centres, *codes.books]
    rows = [(i - 1, *f.shape, bytearray(f.astype("<f8").tobytes())) for i, f in enumerate(frames)]
    spark.createDataFrame(rows, kinds).coalesce(1).write.mode("errorifexists").parquet(f"{path}/{_MODEL}")


def load_codes(spark: SparkSession, path: str) -> Codes:
    """The centres and codebooks of an index; their size does not depend on the table."""
    rows = sorted(spark.read.parquet(f"{path}/{_MODEL}").collect(), key=lambda r: r["part"])
    frames = [np.frombuffer(r["numbers"], "<f8").reshape(r["rows"], r["width"]) for r in rows]
    return Codes(frames[0], frames[1:])


def load_depth(spark: SparkSession, path: str) -> Depth:
    return Depth(*spark.read.parquet(f"{path}/{_CALIBRATION}").select("lists", "compared", "top_k", "recall").first())


def encoded(vectors: DataFrame, codes: Codes) -> DataFrame:
    """``id, embedding, code, list`` of the vectors that can be searched."""
    usable = _usable(vectors)
    shared = usable.sparkSession.sparkContext.broadcast(codes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _CODES):
                part = batch.slice(first, _CODES)
                lists, found = shared.value.encode(_matrix(part.column("embedding")))
                code = pa.array([c.tobytes() for c in found], pa.binary())
                part = part.append_column("code", code)
                yield part.append_column("list", pa.array(lists.astype(np.int32)))

    more = [T.StructField("code", T.BinaryType()), T.StructField("list", T.IntegerType())]
    return usable.mapInArrow(assign, T.StructType([*usable.schema.fields, *more]))


def write_encoded(rows: DataFrame, folder: str, mode: str = "append") -> None:
    """Write encoded vectors, a folder for each list; long lists are written by several tasks."""
    spread = rows.repartition("list", F.pmod(F.xxhash64("id"), F.lit(8)))
    spread.sortWithinPartitions("list", "id").write.mode(mode).partitionBy("list").parquet(folder)


def build_quantised_index(
    vectors: DataFrame, path: str, settings: Quantising = Quantising(), stored: bool = True
) -> None:
    """Train, store all vectors with their codes, and calibrate; the folder must be new.

    ``vectors`` has distinct ``id`` and ``embedding``. A table without vectors is an error.
    Without ``stored`` the encoded vectors are not kept in the index's folder.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors)
    count = usable.count()
    if not count:
        raise ValueError("an index needs vectors to be trained on")
    sample = usable.where(_drawn(settings.sample / count, 1)).toArrow()
    if not sample.num_rows:
        sample = usable.limit(settings.sample).toArrow()
    lists = settings.lists or max(1, count // settings.per_list)
    codes = _train(spark, sample, max(1, min(lists, sample.num_rows // 8 or 1)), settings)
    _save_model(spark, codes, path)
    if stored:
        write_encoded(encoded(vectors, codes), f"{path}/{_VECTORS}")
        rows = own_vectors(spark, path)
    else:
        rows = materialise(encoded(vectors, codes), "encoded")
    depth = _calibrate(rows, codes, count, settings)
    row = [(depth.lists, depth.compared, depth.top_k, depth.recall)]
    kinds = "lists int, compared int, top_k int, recall double"
    spark.createDataFrame(row, kinds).coalesce(1).write.mode("errorifexists").parquet(f"{path}/{_CALIBRATION}")


def is_quantised(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds an index of this kind."""
    try:
        spark.read.parquet(f"{path}/{_MODEL}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def add_to_quantised_index(vectors: DataFrame, path: str) -> None:
    """Store further vectors with the codes of an index."""
    write_encoded(encoded(vectors, load_codes(vectors.sparkSession, path)), f"{path}/{_VECTORS}")


def own_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The encoded vectors in the folder of an index."""
    return spark.read.parquet(f"{path}/{_VECTORS}")


def _calibrate(stored: DataFrame, codes: Codes, count: int, settings: Quantising) -> Depth:
    """The fewest lists, and then the fewest vectors, that reach the recall.

    A calibrating vector is not its own neighbour. Doubles the lists until the recall is
    reached; if all lists do not reach it, the depth says so by its own recall.
    """
    own = stored.where(_drawn(settings.queries / count, 2)).select(F.col("id").alias("query_id"), "embedding")
    own = materialise(own, "calibrating")
    most = settings.most * settings.top_k
    truth = search_many(stored.select("id", "embedding"), own, settings.top_k + 1)
    truth = truth.where(F.col("query_id") != F.col("id")).where(F.col("rank") <= settings.top_k + 1)
    first = Window.partitionBy("query_id").orderBy("rank")
    truth = truth.withColumn("place", F.row_number().over(first)).where(F.col("place") <= settings.top_k)
    truth = materialise(truth.select("query_id", "id"), "truth")
    wanted = truth.count()
    lists, best = max(1, len(codes.centres) // 16), Depth(len(codes.centres), most, settings.top_k, 1.0)
    while wanted:
        near = _near_codes(stored, codes, own, lists, most + 1).where(F.col("query_id") != F.col("id"))
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("guess").desc(), "id"))
        hits = near.withColumn("place", place).join(truth, ["query_id", "id"])
        places = np.sort([r[0] for r in hits.select("place").collect()])
        need = int(np.ceil(settings.recall * wanted))
        if len(places) >= need:
            # One more for the vector itself, which a search may find.
            compared = max(int(places[need - 1]), settings.top_k) + 1
            return Depth(lists, compared, settings.top_k, float((places < compared).sum() / wanted))
        best = Depth(lists, most, settings.top_k, len(places) / wanted)
        if lists == len(codes.centres):
            break
        lists = min(2 * lists, len(codes.centres))
    return best


def _near_codes(stored: DataFrame, codes: Codes, queries: DataFrame, lists: int, keep: int) -> DataFrame:
    """``query_id, list, id, guess``: for each query the best ``keep`` codes of its nearest ``lists``.

    Blocks of queries meet blocks of codes of the same list, one join for any number of queries;
    Spark sends the queries to all tasks if they are small enough.
    """
    spark = stored.sparkSession
    shared = spark.sparkContext.broadcast(codes)
    key, id_type = queries.schema["query_id"].dataType, stored.schema["id"].dataType
    name, kind = key.simpleString(), to_arrow_type(key)

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                rows = np.array(frame["embedding"].tolist(), dtype=np.float64)
                rows /= np.linalg.norm(rows, axis=1, keepdims=True)
                order = np.argsort(-(rows @ shared.value.centres.T), axis=1, kind="stable")[:, :lists]
                units = [r.tobytes() for r in rows.astype("<f4")]
                yield pd.DataFrame({"query_id": frame["query_id"], "unit": units, "lists": list(order.astype(np.int32))})

    asked = queries.select("query_id", "embedding").mapInPandas(probe, f"query_id {name}, unit binary, lists array<int>")
    asked = asked.select("query_id", "unit", F.explode("lists").alias("list"))
    # Queries of a list in groups of about `_QUERIES`; a list that all of them read has
    # larger groups by as much as it is read more often than others.
    blocks = max(1, -(-queries.count() * lists // (len(codes.centres) * _QUERIES)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    asked = asked.groupBy("list", "block").agg(F.collect_list(F.struct("query_id", "unit")).alias("asked")).drop("block")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("list").to_numpy()
            edges = np.flatnonzero(np.diff(lists, prepend=-1, append=-1)).tolist()
            for start, stop in zip(edges, edges[1:]):
                for first in range(start, stop, _CODES):
                    part = batch.slice(first, min(_CODES, stop - first))
                    found = b"".join(part.column("code").to_pylist())
                    columns = [[int(lists[start])], [part.column("id").to_pylist()], [found]]
                    arrays = [pa.array(c, f.type) for c, f in zip(columns, packed_type)]
                    yield pa.RecordBatch.from_arrays(arrays, ["list", "ids", "codes"])

    packed_schema = T.StructType(
        [
            T.StructField("list", T.IntegerType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("codes", T.BinaryType()),
        ]
    )
    packed_type = pa.schema([("list", pa.int32()), ("ids", pa.list_(pa.int64())), ("codes", pa.binary())])
    packed = stored.select("list", "id", "code").mapInArrow(pack, packed_schema)
    met = packed.join(asked, "list")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By query: list, id and guess of the best so far.
        best: dict = {}
        for batch in batches:
            for row in range(batch.num_rows):
                number = batch.column("list")[row].as_py()
                ids = batch.column("ids")[row].values.to_numpy()
                found = np.frombuffer(batch.column("codes")[row].as_buffer(), np.uint8).reshape(len(ids), -1)
                group = batch.column("asked")[row].as_py()
                units = np.stack([np.frombuffer(q["unit"], "<f4") for q in group])
                guesses = (units @ shared.value.centres[number].astype(np.float32))[:, None]
                tables = shared.value.tables(units)
                guesses = reduce(np.add, (tables[:, p, found[:, p]] for p in range(found.shape[1])), guesses)
                for query, guess in zip(group, guesses):
                    part = np.arange(len(ids)) if len(ids) <= keep else np.argpartition(-guess, keep - 1)[:keep]
                    known = best.get(query["query_id"])
                    new = (np.full(len(part), number, np.int32), ids[part], guess[part])
                    if known is not None:
                        new = tuple(np.concatenate(pair) for pair in zip(known, new))
                        if len(new[1]) > 2 * keep:
                            top = np.argpartition(-new[2], keep - 1)[:keep]
                            new = tuple(column[top] for column in new)
                    best[query["query_id"]] = new
        for query, columns in best.items():
            top = np.lexsort((columns[1], -columns[2]))[:keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array([query] * len(top), kind), *(pa.array(c[top]) for c in columns)],
                names=["query_id", "list", "id", "guess"],
            )

    output = f"query_id {name}, list int, id {id_type.simpleString()}, guess float"
    scored = met.mapInArrow(score, output)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("guess").desc(), "id"))
    return scored.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank")


def quantised_search_many(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    top_k: int = 10,
    depth: Depth | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """The ``top_k`` found for every query: ``query_id, rank, id, similarity``.

    ``queries`` holds distinct ``query_id`` and ``embedding``; zero and NULL queries have no hits.
    ``depth`` is the calibrated one if none is given; for more hits than it was calibrated for, as many
    times more vectors are compared. Queries with fewer than ``top_k`` hits are asked again in
    twice as many lists. ``stored`` are the encoded vectors, by default those in the index's folder.
    """
    codes = load_codes(spark, path)
    depth = depth or load_depth(spark, path)
    stored = own_vectors(spark, path) if stored is None else stored
    compared = -(-depth.compared * max(top_k, depth.top_k) // depth.top_k)
    usable = queries.where(F.exists("embedding", lambda x: x != 0)).select("query_id", "embedding")
    left, lists, answered = materialise(usable, "asked"), min(depth.lists, len(codes.centres)), []
    while True:
        near = _near_codes(stored, codes, left, lists, compared).drop("guess")
        exact = near.join(stored.select("list", "id", "embedding"), ["list", "id"])
        asked = left.withColumnRenamed("embedding", "_asked")
        exact = exact.join(asked, "query_id").select(
            "query_id", "id", cosine_similarity(F.col("embedding"), F.col("_asked")).alias("similarity")
        )
        order = Window.partitionBy("query_id").orderBy(F.round("similarity", PRECISION).desc(), "id")
        hits = exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)
        hits = materialise(hits.select("query_id", "rank", "id", "similarity"), "hits")
        if lists == len(codes.centres):
            return reduce(DataFrame.unionAll, [*answered, hits])
        full = hits.where(F.col("rank") == top_k).select("query_id")
        answered.append(hits.join(full, "query_id", "left_semi"))
        left = materialise(left.join(full, "query_id", "left_anti"), "asked")
        if left.isEmpty():
            return reduce(DataFrame.unionAll, answered)
        lists = min(2 * lists, len(codes.centres))


def quantised_search(
    vectors: DataFrame,
    path: str,
    query: Sequence[float],
    top_k: int = 10,
    depth: Depth | None = None,
    columns: Sequence[str] = HIT_COLUMNS,
    stored: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``vectors`` found for one query, with their ``similarity``."""
    spark = vectors.sparkSession
    asked = spark.createDataFrame([(0, [float(x) for x in query])], "query_id int, embedding array<float>")
    found = quantised_search_many(spark, path, asked, top_k, depth, stored).select("id", "similarity")
    # At most k rows.
    joined = vectors.select(*dict.fromkeys(["id", *columns])).join(F.broadcast(found), "id")
    return joined.orderBy(*best_first()).select(*columns, "similarity")
