"""Dense ids without a single-partition window over the data."""

from pyspark.sql import DataFrame, Window, functions as F

from folia.session import scratch_path

# monotonically_increasing_id() counts within a partition in its low 33 bits.
_IN_PARTITION = (1 << 33) - 1


def with_dense_ids(frame: DataFrame, order: list[str], start: int = 1) -> DataFrame:
    """Add ``id``: ``start``, ``start + 1``, ... in the given order.

    The rows are range-partitioned and sorted, and written to the shared scratch folder
    with their partition and position, so that a lost executor cannot shift them. Only
    the row count per partition, one row each, is then summed up in one place.
    """
    spark = frame.sparkSession
    staged_path = scratch_path(spark, "ids")
    staged = (
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mark", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_mark", 33))
        .withColumn("_row", F.col("_mark").bitwiseAND(F.lit(_IN_PARTITION)))
        .drop("_mark")
    )
    staged.write.parquet(staged_path)
    rows = spark.read.schema(staged.schema).parquet(staged_path)

    counts = rows.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    # One row per partition of the staged table: safe to broadcast.
    numbered = rows.join(F.broadcast(offsets), "_part")
    return numbered.withColumn("id", F.col("_offset") + F.col("_row") + start).drop(
        "_part", "_row", "_offset"
    )
