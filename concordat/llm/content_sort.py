"""Exact duplicates by a content sort.

Sampled cuts range-partition the normalised texts; each part is sorted, which places equal texts
next to each other; neighbours are compared in full and every run of equal texts is folded to its
best row.  A text that fills several parts by itself is dealt over them by its id.  All runs are
grouped again by SHA-256 and length, and every row finds its group by the digest, so in the result
equal texts are those of equal digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import partitions, range_slot, sampled_cuts, text_or_empty

# Code points of the normalised text that place a row; the sort and the comparison use all.
PLACING = 48
# Parts for each shuffle partition, so that an uneven hash of the parts still fills all tasks.
PARTS = 4


def normalised(text: Column) -> Column:
    """``text`` without any of space, tab, line feed, vertical tab, form feed and return."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``; other columns are left out).

    Texts are equal when their normalised forms are.  Of equal texts the row with the most code
    points stays, then the one with the smallest id; a missing id comes after all others.  A
    missing text counts as empty, and empty texts equal each other.  Rows that repeat both id and
    text are one document: all of them count and share one verdict.  An empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        "doc_id",
        normalised(text_or_empty()).alias("body"),
        F.length(text_or_empty()).alias("chars"),
    )
    place = F.substring("body", 1, PLACING)
    parts = partitions(spark)
    cuts = sampled_cuts(keyed.select(place), PARTS * parts)
    best = F.struct(
        (-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("nameless"), "doc_id"
    )
    runs = (
        keyed.withColumn("part", range_slot(place, cuts, F.col("doc_id")))
        .repartition(parts, "part")
        .sortWithinPartitions("part", "body")
        .groupBy("part", "body")
        .agg(F.min(best).alias("best"), F.count("*").alias("n"))
    )
    digest = F.sha2("body", 256)
    groups = (
        runs.select(digest.alias("digest"), F.octet_length("body").alias("bytes"), "best", "n")
        .groupBy("digest", "bytes")
        .agg(F.min("best").alias("best"), F.sum("n").alias("group_size"))
        .select(F.col("digest").alias("text_sha256"), "best", "group_size")
    )
    each = keyed.select("doc_id", "chars", digest.alias("text_sha256"))
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("chars") == -F.col("best.chars"))
    return each.join(groups, "text_sha256").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        stays.alias("kept"),
        "text_sha256",
    )
