"""A listing of objects as a data source, as a bucket shows them.

Spark's own file sources hide names that start with ``_`` or ``.``; this one shows all. The folder
that a prefix names is looked into once to plan the work; each folder in it is then
listed, with all below it, by a task of its own. With ``spark.sql.python.filterPushdown.enabled``,
what a query asks of the names' start is pushed down, so folders that cannot match are not listed.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    Filter,
    InputPartition,
    StringStartsWith,
)

from folia.schemas import LISTING

FORMAT = "folia_objects"
# Objects of a batch.
_ROWS = 10_000


@dataclass
class _Folder(InputPartition):
    """What one task lists: a folder with all below it, or the objects of a folder alone."""

    path: str
    deep: bool


class ObjectSource(DataSource):
    """Options: ``path``, the URI of a bucket or folder, and ``prefix``, how the names start."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return LISTING

    def reader(self, schema) -> "ObjectReader":
        kind = PushedReader if self.options.get("pushed") == "true" else ObjectReader
        return kind(self.options["path"], self.options.get("prefix", ""))


class ObjectReader(DataSourceReader):
    def __init__(self, root: str, prefix: str):
        self._root, self._prefix = root.rstrip("/"), prefix

    def _open(self) -> tuple[fs.FileSystem, str]:
        if "://" not in self._root and not self._root.startswith("file:"):
            return fs.LocalFileSystem(), self._root
        store, path = fs.FileSystem.from_uri(self._root)
        return store, path.rstrip("/")

    def partitions(self) -> list[InputPartition]:
        store, base = self._open()
        above = self._prefix.rpartition("/")[0]
        start = f"{base}/{above}" if above else base
        # The root must be there; without a folder of the prefix there are no objects.
        selector = fs.FileSelector(start, allow_not_found=bool(above), recursive=False)
        found = store.get_file_info(selector)
        wanted = f"{base}/{self._prefix}"
        folders = [
            _Folder(i.path, True)
            for i in found
            if i.type == fs.FileType.Directory and f"{i.path}/".startswith(wanted)
        ]
        return [_Folder(start, False), *folders]

    def read(self, partition: _Folder) -> Iterator[pa.RecordBatch]:
        store, base = self._open()
        selector = fs.FileSelector(partition.path, allow_not_found=True, recursive=partition.deep)
        wanted, rows = f"{base}/{self._prefix}", []
        for info in store.get_file_info(selector):
            if info.type == fs.FileType.File and info.path.startswith(wanted):
                name = info.path[len(base) + 1 :]
                rows.append((f"{self._root}/{name}", name, info.size, info.mtime))
        for first in range(0, len(rows), _ROWS):
            columns = zip(*rows[first : first + _ROWS])
            kinds = (pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, LISTING.names)


class PushedReader(ObjectReader):
    """For sessions that push filters down to such sources; others refuse a reader that takes them."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take over what is asked of the start of the names."""
        for given in filters:
            if isinstance(given, StringStartsWith) and given.attribute == ("name",):
                if given.value.startswith(self._prefix):
                    self._prefix = given.value
                    continue
                if self._prefix.startswith(given.value):
                    continue
            yield given


def list_bucket(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """All objects below ``root`` whose names start with ``prefix``, hidden names included.

    ``root`` is a local folder or the URI of one that pyarrow can open (``s3://``, ``gs://``, ``hdfs://``). A
    prefix without objects gives none; a root that is not there is an error.
    """
    spark.dataSource.register(ObjectSource)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    options = {"path": root, "prefix": prefix, "pushed": pushed.lower()}
    return spark.read.format(FORMAT).options(**options).load()
