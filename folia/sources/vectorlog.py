"""The vector table as a folder that several writers append to at once.

Each append is a batch: a folder of rows, and one of the same vectors encoded for the index if
there is one. It reserves its ids first and then writes; a single entry of the commit log makes
rows and index visible together. A writer that dies in between leaves unused ids, as a
sequence of a database does, and files that nobody reads.
"""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from folia.config import Settings
from folia.operators import quantised
from folia.operators.quantised import Depth, Quantising
from folia.operators.search import HIT_COLUMNS
from folia.schemas import VECTORS
from folia.session import materialise
from folia.sources.commits import CommitLog, Entry, State
from folia.sources.vectorrows import Embed, vector_rows

_KEY = ["source", "chunk_index"]


class VectorLog:
    """The vectors under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self._root}/log")

    def _batch(self, name: str) -> str:
        return f"{self._root}/data/batch={name}"

    def _codes(self, index: str, name: str) -> str:
        return f"{self._root}/codes/index={index}/batch={name}"

    def _index(self, index: str) -> str:
        return f"{self._root}/index/{index}"

    def _rows(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self._spark.createDataFrame([], VECTORS)
        return self._spark.read.schema(VECTORS).parquet(*map(self._batch, names))

    def table(self, state: State | None = None) -> DataFrame:
        """All committed rows, those of one state of the log."""
        return self._rows(list((state or self.log.state()).batches))

    def _encode(self, index: str, names: Sequence[str]) -> None:
        """Encode batches for an index; repeating it replaces what it left before."""
        codes = quantised.load_codes(self._spark, self._index(index))
        for name in names:
            rows = quantised.encoded(self._rows([name]), codes)
            quantised.write_encoded(rows, self._codes(index, name), "overwrite")

    def append(
        self,
        chunks: DataFrame,
        settings: Settings = Settings(),
        dedupe: bool = False,
        embed: Embed | None = None,
    ) -> int:
        """Append chunks as one batch and return their first id.

        With ``dedupe``, chunks that are stored already are left out, also those that another
        writer stores in the meantime.
        """
        base = self.log.state()
        stored = self.table(base) if dedupe else None
        rows = vector_rows(chunks, settings.embedding_dimensions, 0, stored, embed)
        if embed is not None:
            # A model's step runs once; the feature hash is not worth a second copy of all vectors.
            rows = materialise(rows, "append")
        number = rows.count()
        _, reserved = self.log.commit(
            lambda state: {"kind": "reserve", "first_id": state.next_id, "rows": number}
        )
        first = reserved["first_id"]
        rows = rows.withColumn("id", F.col("id") + first)
        batch: list[str] = []
        known = set(base.batches)
        indexes: set[str] = set()

        def write(state: State) -> Entry:
            nonlocal rows
            new = [name for name in state.batches if name not in known]
            if not batch or dedupe and new:
                if dedupe and new:
                    rows = rows.join(self._rows(new).select(*_KEY), _KEY, "left_anti")
                    known.update(new)
                batch[:] = [uuid.uuid4().hex]
                indexes.clear()
                rows.select(*VECTORS.names).write.parquet(self._batch(batch[0]))
            if state.index is not None and state.index not in indexes:
                self._encode(state.index, batch)
                indexes.add(state.index)
            return {"kind": "append", "batch": batch[0], "first_id": first, "rows": number}

        self.log.commit(write)
        return first

    def build_index(self, settings: Quantising = Quantising()) -> None:
        """Train an index on the committed rows and encode all of them.

        Batches that are committed in the meantime are encoded before the index counts.
        """
        state = self.log.state()
        name, rows = uuid.uuid4().hex, sum(b["rows"] for b in state.batches.values())
        quantised.build_quantised_index(self.table(state), self._index(name), settings, stored=False)
        done: set[str] = set()

        def encode(state: State) -> Entry:
            missing = [b for b in state.batches if b not in done]
            self._encode(name, missing)
            done.update(missing)
            return {"kind": "index", "index": name, "rows": rows}

        self.log.commit(encode)

    def refresh_index(self, settings: Quantising = Quantising(), growth: float = 1.0) -> bool:
        """Train the index anew if there is none or the table has grown by more than ``growth``.

        Later vectors are stored under the centres and codebooks of the training; where they are
        many, and of another kind, these no longer tell them apart.
        """
        state = self.log.state()
        rows = sum(b["rows"] for b in state.batches.values())
        if not rows or state.index is not None and rows <= (1 + growth) * state.trained:
            return False
        self.build_index(settings)
        return True

    def search_many(
        self, queries: DataFrame, top_k: int = 10, depth: Depth | None = None
    ) -> DataFrame:
        """The ``top_k`` of every query, found by the index: ``query_id, rank, id, similarity``."""
        state = self.log.state()
        if state.index is None:
            raise ValueError("there is no index yet")
        path = self._index(state.index)
        return quantised.quantised_search_many(self._spark, path, queries, top_k, depth, self._encoded(state))

    def search(
        self,
        query: Sequence[float],
        top_k: int = 10,
        depth: Depth | None = None,
        columns: Sequence[str] = HIT_COLUMNS,
    ) -> DataFrame:
        """The rows found for one query by the index, with their ``similarity``."""
        state = self.log.state()
        if state.index is None:
            raise ValueError("there is no index yet")
        path, stored = self._index(state.index), self._encoded(state)
        return quantised.quantised_search(self.table(state), path, query, top_k, depth, columns, stored)

    def _encoded(self, state: State) -> DataFrame:
        """The encoded vectors of all committed batches, as one scan."""
        base = f"{self._root}/codes/index={state.index}"
        folders = [self._codes(state.index, name) for name in state.batches]
        # A batch without a usable vector has no list.
        schema = "id long, embedding array<float>, code binary, batch string, list int"
        reader = self._spark.read.schema(schema).option("basePath", base)
        return reader.parquet(*folders).drop("batch")
