"""The index of processed files: one URI per row, appended to and read as a set.

The index lies in buckets by the hash of the URI, so joining a listing with it, or removing
repetitions, shuffles the listing alone, however long the index has become. Every append
adds a file to each bucket; :func:`compact_index` makes one file of them.
"""

from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from folia.schemas import PROCESSED

# Part of the layout of an index: the same for all that write to it.
BUCKETS = 32


def _buckets(spark: SparkSession, path: str) -> str:
    """The name of the table over the buckets of an index; this session knows it by its folder."""
    folder = f"{path.rstrip('/')}_by_uri"
    name = f"folia_index_{md5(folder.encode()).hexdigest()}"
    quoted = folder.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (uri STRING) USING parquet "
        f"CLUSTERED BY (uri) SORTED BY (uri) INTO {BUCKETS} BUCKETS LOCATION '{quoted}'"
    )
    # Other sessions may have added files.
    spark.catalog.refreshTable(name)
    return name


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The processed URIs; a missing index is empty, an unreadable file is an error.

    An index read in part would have files processed and stored again. A snapshot at ``path``
    belongs to the index.
    """
    appended = spark.table(_buckets(spark, path))
    try:
        snapshot = spark.read.schema(PROCESSED).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        # Equal URIs are in one bucket.
        return appended.distinct()
    return appended.union(snapshot).distinct()


def add_to_index(uris: DataFrame, path: str) -> None:
    """Append URIs to the buckets; one file each."""
    name = _buckets(uris.sparkSession, path)
    rows = uris.select("uri").distinct().repartition(BUCKETS, "uri")
    rows.write.mode("append").insertInto(name)


def compact_index(spark: SparkSession, path: str, to: str) -> None:
    """Write the index to a new place with one file in each bucket; readers move there."""
    if not spark.table(_buckets(spark, to)).isEmpty():
        raise FileExistsError(f"there is an index at {to}")
    add_to_index(read_index(spark, path), to)


def index_snapshot(index: DataFrame) -> DataFrame:
    """The index without repetitions and sorted."""
    return index.select("uri").distinct().orderBy("uri")


def write_snapshot(index: DataFrame, path: str) -> None:
    """Write a sorted index to a new folder; readers move to it when it is complete."""
    index_snapshot(index).write.mode("errorifexists").parquet(path)


def union_index(processed: DataFrame, uris: DataFrame) -> DataFrame:
    return processed.select("uri").union(uris.select("uri")).distinct()
