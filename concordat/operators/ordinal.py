"""Positions in a total order, and groups of bounded size cut along it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id() keeps the row's place in its partition here


def with_ordinal(df: DataFrame, key: str, name: str = "ordinal") -> DataFrame:
    """Add the zero-based position of every row in the order of ``key``, which must be unique.

    Rows are range-partitioned and numbered inside their partitions; each partition then adds the
    row counts of those before it.  The numbered rows are written out first, because the partition
    bounds come from a sample and must not be drawn twice.
    """
    ranged = df.repartitionByRange(key).sortWithinPartitions(key)
    numbered = materialize(
        ranged.select(
            "*",
            F.spark_partition_id().alias("__part"),
            F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1).alias("__place"),
        )
    )
    # One row per partition from here on.
    sizes = numbered.groupBy("__part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("__part")) - F.col("n")
    offsets = sizes.select("__part", before.alias("__before"))
    return (
        numbered.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + F.col("__place"))
        .drop("__part", "__place", "__before")
    )


def in_batches(df: DataFrame, key: str, size: int, name: str = "batch") -> DataFrame:
    """Number consecutive groups of at most ``size`` rows in the order of ``key``."""
    ordered = with_ordinal(df, key)
    return ordered.withColumn(name, F.floor(F.col("ordinal") / size).cast("bigint"))
