"""Result records as JSON."""

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from folia.functions.naming import iso_utc, result_path
from folia.schemas import LAYOUT_CHUNK, METADATA, TEXT_CHUNK
from folia.session import materialise

# Keys of the JSON record and the columns they hold.
JSON_KEYS = {
    "source": "source",
    "filename": "filename",
    "raw_char_count": "raw_char_count",
    "cleaned_char_count": "cleaned_char_count",
    "metadata": "metadata",
    "docai_chunks_count": "layout_chunk_count",
    "langchain_chunks_count": "text_chunk_count",
    "docai_chunks": "layout_chunks",
    "langchain_chunks": "text_chunks",
}

_RECORD = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("raw_char_count", T.IntegerType()),
        T.StructField("cleaned_char_count", T.IntegerType()),
        T.StructField("metadata", METADATA),
        T.StructField("docai_chunks_count", T.IntegerType()),
        T.StructField("langchain_chunks_count", T.IntegerType()),
        T.StructField("docai_chunks", T.ArrayType(LAYOUT_CHUNK)),
        T.StructField("langchain_chunks", T.ArrayType(TEXT_CHUNK)),
    ]
)


def stamped_metadata() -> Column:
    """The metadata as stored: the time as ISO text, the same in every sink."""
    moment = F.col("metadata.extracted_at")
    return F.col("metadata").withField("extracted_at", iso_utc(moment.cast("timestamp"), "Z"))


def record() -> Column:
    """The JSON record of a row of processed documents."""
    values = {key: F.col(column) for key, column in JSON_KEYS.items()}
    values["metadata"] = stamped_metadata()
    return F.struct(*(value.alias(key) for key, value in values.items()))


def with_output_path(processed: DataFrame) -> DataFrame:
    return processed.withColumn("output_path", result_path(F.col("filename")))


def path_winners(files: DataFrame) -> DataFrame:
    """``output_path, name`` of the file whose result stays when paths collide.

    Files come in the order of their names and a later result overwrites an earlier
    one, so the largest name stays. Only names take part, combined before the shuffle,
    so a path shared by many files is no hot spot.
    """
    return files.groupBy("output_path").agg(F.max("name").alias("name"))


def keep_path_winners(processed: DataFrame, files: DataFrame) -> DataFrame:
    """Drop processed documents whose result another one of ``files`` overwrites.

    Few files lose their path, so the losers are looked up, by name only.
    """
    keys = ["output_path", "name"]
    losers = files.select(keys).join(path_winners(files), keys, "left_anti")
    return processed.join(losers, keys, "left_anti")


def path_collisions(files: DataFrame) -> DataFrame:
    counted = files.groupBy("output_path").agg(
        F.count("*").alias("files"), F.max("name").alias("kept")
    )
    return counted.where("files > 1")


def run_folder(path: str, run: str) -> str:
    """Where the records of a run are."""
    return f"{path.rstrip('/')}/run={run}"


_MANIFEST = "output_path string, file string, written_at long, run string"


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}_manifest"


def write_results(processed: DataFrame, path: str, run: str) -> None:
    """Write one JSON record per document under ``path``, as the results of ``run``.

    Repeating a run replaces its own results. A manifest beside the records has the output
    paths of each run, the files they are in, and when they were written: the last one written
    counts, see :func:`current_results`. The name of a run only serves to replace it.
    """
    flat = processed.select("output_path", record().alias("r")).select("output_path", "r.*")
    folder = run_folder(path, run)
    flat.write.mode("overwrite").json(folder)
    written = processed.sparkSession.read.schema("output_path string").json(folder).select(
        "output_path",
        F.col("_metadata.file_name").alias("file"),
        F.lit(time.time_ns() // 1000).alias("written_at"),
    )
    written.write.mode("overwrite").parquet(f"{_manifest(path)}/run={run}")


def current_results(spark: SparkSession, path: str) -> DataFrame:
    """For every output path the result written last.

    Which run and file that is follows from the manifest alone; of all files ever written, only
    those that hold such a result are read. The driver knows the names of these files.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(_manifest(path))
    order = F.struct("written_at", "run", "file")
    last = manifest.groupBy("output_path").agg(F.max_by(F.struct("run", "file"), order).alias("last"))
    last = materialise(last.select("output_path", "last.*"), "last")
    schema = T.StructType(
        [
            T.StructField("output_path", T.StringType()),
            *_RECORD.fields,
            T.StructField("run", T.StringType()),
        ]
    )
    keys = ["output_path", "run"]
    files = [f"{run_folder(path, r['run'])}/{r['file']}" for r in last.select("run", "file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], schema).select(*keys, *_renamed())
    written = spark.read.schema(schema).option("basePath", path).json(files)
    return written.join(last, keys, "left_semi").select(*keys, *_renamed())


def read_results(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Result records with the column names used here.

    ``multi_line`` reads files holding one pretty-printed record each.
    """
    found = spark.read.schema(_RECORD).json(path, multiLine=multi_line)
    return found.select(*_renamed())


def _renamed() -> list[Column]:
    return [F.col(key).alias(column) for key, column in JSON_KEYS.items()]


def result_chunks(results: DataFrame) -> DataFrame:
    """One row per text chunk; a chunk without an index takes its position."""
    # Once for each document: what stands beside a generator is computed for each of its rows.
    told = results.select("source", "filename", F.to_json(stamped_metadata()).alias("metadata"), "text_chunks")
    # Without "outer", a filter on the number of chunks is pushed below and processes every text again.
    chunk = F.posexplode_outer("text_chunks").alias("position", "chunk")
    exploded = told.select("source", "filename", "metadata", chunk)
    return exploded.where(F.col("position").isNotNull()).select(
        "source",
        "filename",
        F.coalesce("chunk.chunk_index", "position").alias("chunk_index"),
        "chunk.content",
        "metadata",
    )
