"""Contiguous shards of nearly equal bytes, from prefix sums of per-partition totals.

Documents are range-partitioned by id, each partition's bytes are totalled, and the
prefix sums of the totals shift the running sums within the partitions. The bytes of all
documents are cut at equal targets, so every shard is a contiguous run of ids.
"""

from pyspark.sql import DataFrame, Window, functions as F

from folia.llm.frames import running_offsets, staged, with_text


def balanced_shards(docs: DataFrame, shards: int = 8, order_by: str = "doc_id") -> DataFrame:
    """Deal documents into ``shards`` contiguous runs of nearly equal size.

    Returns ``doc_id, size, text_crc32, start, shard, slot``: ``size`` is the number of
    UTF-8 bytes plus one, ``start`` the bytes of all documents before this one, ``slot``
    the place in the shard, from 0. A document belongs to the shard in whose share of
    the total its middle byte falls, so no shard is off its target by more than one
    document. NULL texts count as empty, NULL ids come first, rows with equal ids stand in
    any order next to each other, an empty table gives no rows. Where there are fewer
    documents than shards, some shards are empty. Only DataFrame functions are used.
    """
    rows = with_text(docs, *([] if order_by == "doc_id" else [order_by])).select(
        "doc_id",
        F.col(order_by).alias("_order"),
        (F.octet_length("text") + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        # Lets rows with the same id be dealt to several partitions.
        F.monotonically_increasing_id().alias("_tie"),
    )
    # Written with its partition number, so that a lost executor cannot shift anything.
    placed = staged(
        rows.repartitionByRange("_order", "_tie").withColumn("_part", F.spark_partition_id()),
        "shard-rows",
    )
    inside = Window.partitionBy("_part").orderBy("_order", "_tie")
    running = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select(
        "*",
        F.coalesce(F.sum("size").over(running), F.lit(0)).alias("_local_start"),
        (F.row_number().over(inside) - 1).cast("long").alias("_local_row"),
    )
    totals = placed.groupBy("_part").agg(
        F.sum("size").alias("_bytes"), F.count("*").alias("_rows")
    )
    offsets = running_offsets(totals, [], ["_bytes", "_rows"])
    everything = placed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("_total"))
    # One row per partition, and a single row: both safe to broadcast.
    placed_globally = (
        local.join(F.broadcast(offsets), "_part")
        .crossJoin(F.broadcast(everything))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("_local_start") + F.col("_before__bytes")).alias("start"),
            (F.col("_local_row") + F.col("_before__rows")).alias("_row"),
            "_total",
        )
    )
    middle = 2 * F.col("start").cast("decimal(38,0)") + F.col("size")
    shard = F.floor(middle * shards / (2 * F.col("_total"))).cast("int")
    assigned = placed_globally.withColumn("shard", shard).drop("_total")
    # The rows run through all shards, so a shard's first row is the rows before it.
    first = assigned.groupBy("shard").agg(F.min("_row").alias("_first"))
    return assigned.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "start",
        "shard",
        (F.col("_row") - F.col("_first")).alias("slot"),
    )
