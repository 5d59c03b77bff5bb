"""Equi-joins that hold up whatever share of the rows one key has."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SALT = "__salt"
_PIECES = "__pieces"

# A right side within both limits is broadcast.  Sending it once to each executor costs far less
# than shuffling the left side.  Each goes through the driver, and a stream sends some in every
# micro-batch, so the limits leave room for many in one job.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 32 * 1024 * 1024
# A key below this many rows is never worth splitting, whatever its share.
MIN_HOT_ROWS = 20_000


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bytes(df: DataFrame) -> Column:
    """About how many bytes a row holds: its texts, and eight for each plain column or field."""

    def texts(column: Column, kind: T.DataType) -> list[Column]:
        if isinstance(kind, T.StringType):
            return [column]
        if isinstance(kind, T.StructType):
            return [text for field in kind for text in texts(column[field.name], field.dataType)]
        return []

    def leaves(kind: T.DataType) -> int:
        if isinstance(kind, T.StructType):
            return sum(leaves(field.dataType) for field in kind)
        return 1

    found = [text for field in df.schema for text in texts(F.col(field.name), field.dataType)]
    return F.octet_length(F.concat_ws("", *found)) + 8 * leaves(df.schema)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df``, counted and measured, is small enough to send to every executor.

    Only flat rows of texts and numbers can be measured; others are never broadcast.
    """
    kinds = [field.dataType for field in df.schema]
    if any(isinstance(kind, (T.ArrayType, T.MapType, T.BinaryType)) for kind in kinds):
        return False
    rows, size = df.agg(F.count("*"), F.sum(_bytes(df))).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def hot_keys(df: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS) -> DataFrame | None:
    """Keys with more rows than an average shuffle partition, and how many such parts each makes.

    At most one key per shuffle partition can be that frequent, so that many of the most frequent
    keys are fetched, with the number of all rows, by one job over one scan.  Counting combines on
    the map side.  None where no key is hot.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    partitions, seen = _shuffle_partitions(df), Observation()
    counted = counts.observe(seen, F.sum("n").alias("total"))
    most = counted.orderBy(F.desc("n")).limit(partitions).collect()
    fair = max((seen.get["total"] or 0) / partitions, min_rows)
    found = [(row[key], math.ceil(row.n / fair)) for row in most if row.n > fair]
    if not found:
        return None
    schema = T.StructType([df.schema[key], T.StructField(_PIECES, T.IntegerType())])
    return df.sparkSession.createDataFrame(found, schema)


def _spread(columns: list[str], pieces: Column) -> Column:
    """A slot below ``pieces`` for a row.

    The input partition is mixed in so that exact copies of one row spread too.  Neither part
    depends on the order in which a task sees its rows, so a task run again after a lost executor
    deals them out the same way.
    """
    return F.pmod(F.xxhash64(*columns) + F.spark_partition_id(), pieces).cast("int")


def _salted(
    left: DataFrame, right: DataFrame, key: str, how: str, hot: DataFrame | None
) -> DataFrame:
    """Join on the key and a salt: rows of a hot key, and those without a key, are dealt over
    many partitions, and the one right-hand row of a hot key is repeated once per piece."""
    without_key = F.when(
        F.col(key).isNull(), _spread(left.columns, F.lit(_shuffle_partitions(left)))
    )
    if hot is None:
        slot = F.coalesce(without_key, F.lit(0))
        copies = F.array(F.lit(0))
    else:
        hot = F.broadcast(hot)
        left, right = left.join(hot, key, "left"), right.join(hot, key, "left")
        of_hot = F.when(F.col(_PIECES).isNotNull(), _spread(left.columns, F.col(_PIECES)))
        slot = F.coalesce(without_key, of_hot, F.lit(0))
        copies = F.sequence(F.lit(0), F.coalesce(F.col(_PIECES), F.lit(1)) - 1)
    # The right-hand salt comes from a generator even where it can only be 0: the optimiser would
    # take a constant out of the join key, and rows without a key would meet in one partition.
    dealt = left.withColumn(_SALT, slot).drop(_PIECES)
    repeated = right.withColumn(_SALT, F.explode(copies)).drop(_PIECES)
    return dealt.join(repeated, [key, _SALT], how).drop(_SALT)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    *,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Equi-join on ``key`` where ``right`` has one row per key.

    A right side measured small is broadcast, so the left one is not shuffled at all.  Beyond
    that both are shuffled, with hot keys found by counting and split.  ``how`` may be ``left``,
    ``inner``, ``left_semi`` or ``left_anti``.
    """
    if fits_broadcast(right):
        return left.join(F.broadcast(right), key, how)
    return _salted(left, right, key, how, hot_keys(left, key, min_hot_rows))
