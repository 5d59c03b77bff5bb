"""Views over registry versions and over the curated table for downstream use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions.checks import is_inactive
from concordat.operators.skew import lookup_join
from concordat.session import materialize


def newly_inactive(before: DataFrame, after: DataFrame) -> DataFrame:
    """Identifiers inactive in ``after`` that were not so in ``before``, new ones included.

    Both have one row per identifier.
    """
    then = before.where(is_inactive(F.col("status"))).select("lei")
    now = after.where(is_inactive(F.col("status"))).select("lei", "status")
    return now.join(then, "lei", "left_anti")


def ultimate_parents(links: DataFrame) -> DataFrame:
    """For each ``entity`` the top of its chain of ``parent`` links, in column ``root``.

    An entity without a parent is its own root; so is a parent that has no row itself the root of
    those below it.  Entities in a cycle, or below one, have a null root.  Each round doubles the
    distance looked up, so a chain of any length takes a logarithmic number of rounds; a round
    that settles nobody shows that only cycles are left.
    """
    start = links.select("entity", F.coalesce("parent", "entity").alias("above"))
    known = links.select(F.col("entity").alias("above"), F.lit(True).alias("__listed"))
    # An unlisted parent ends the chain just as a listed one without a parent does.
    ends = links.select("entity", F.col("parent").isNull().alias("__top"))
    first = lookup_join(start, known, "above").join(ends, "entity")
    hops = materialize(
        first.select(
            "entity", "above", (F.col("__top") | F.col("__listed").isNull()).alias("settled")
        )
    )
    open_rows = hops.where(~F.col("settled")).count()
    while open_rows:
        further = hops.select(
            F.col("entity").alias("above"),
            F.col("above").alias("__next"),
            F.col("settled").alias("__settled"),
        )
        seen = lookup_join(hops, further, "above")
        moved = F.when(F.col("settled"), F.col("above")).otherwise(F.col("__next"))
        hops = materialize(
            seen.select(
                "entity", moved.alias("above"), (F.col("settled") | F.col("__settled")).alias("settled")
            )
        )
        left = hops.where(~F.col("settled")).count()
        if left == open_rows:
            break
        open_rows = left
    return hops.select("entity", F.when(F.col("settled"), F.col("above")).alias("root"))


def status_mart(curated: DataFrame) -> DataFrame:
    """Curated rows and their mean score by registered country and status."""
    tenths = F.sum(F.round(F.col("quality_score") * 10).cast("bigint"))
    return curated.groupBy("gleif_country", "verification_status").agg(
        F.count("*").alias("records"),
        F.round(tenths / (F.count("*") * 10), 4).alias("mean_score"),
    )


def write_mart(mart: DataFrame, path: str) -> None:
    """Write a mart partitioned by status."""
    mart.write.mode("overwrite").partitionBy("verification_status").parquet(path)
