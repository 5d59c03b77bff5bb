"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(df: DataFrame, key: str, order: str | Column) -> DataFrame:
    """Per key, the row with the greatest ``order``; columns and their order are kept.

    An aggregate, not a window: a key with very many rows is reduced before the shuffle.  Null
    keys are dropped.
    """
    order = F.col(order) if isinstance(order, str) else order
    rest = [name for name in df.columns if name != key]
    newest = F.max_by(F.struct(*rest), order).alias("row")
    reduced = df.where(F.col(key).isNotNull()).groupBy(key).agg(newest)
    return reduced.select(*[key if name == key else f"row.{name}" for name in df.columns])
