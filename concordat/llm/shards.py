"""Contiguous shards of nearly equal size by global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.common import staged, text_or_empty

# What a stored document takes beside its text.
OVERHEAD = 8


def assign_shards(docs: DataFrame, shards: int) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) put into shards ``0`` to ``shards - 1``.

    Documents stand in the order of their ids (a missing id first; equal ids by checksum and size).
    The table is cut into sorted blocks; the blocks' totals, one row a block, give each block's
    offset, and a running sum inside the block gives each document's place in the whole.  A
    document belongs to the shard in which its middle byte falls, so shards are contiguous and each
    differs from an equal share by less than its largest document.  With fewer documents than
    shards some shards stay empty; an empty table gives an empty result.  A missing text has no
    bytes.
    """
    text = text_or_empty()
    sized = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size"]
    blocks = staged(
        sized.repartitionByRange(*order).withColumn("block", F.spark_partition_id()), "shards"
    )
    totals = blocks.groupBy("block").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each block, so its size is the number of partitions.
    offsets = totals.select(
        "block",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    whole = totals.agg(F.sum("bytes")).first()[0] or 1
    inside = Window.partitionBy("block").orderBy(*order)
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = (
        blocks.withColumn("upto", running)
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(offsets), "block")
        .withColumn("before", F.col("bytes_before") + F.col("upto") - F.col("size"))
        .withColumn("rank", F.col("rows_before") + F.col("nth") - 1)
        .withColumn("cut", F.expr(f"((2 * before + size) * {shards}) div (2 * {whole})"))
        .withColumn("shard", F.least(F.col("cut"), F.lit(shards - 1)).cast("int"))
    )
    # One row for each shard.
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
