"""The authoritative registry: reading its pages and looking records up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat import schemas as S
from concordat.functions.text import present
from concordat.operators.dedupe import last_wins
from concordat.operators.ordinal import in_batches


def read_pages(
    spark: SparkSession, path: str | list[str], *, multiline: bool = False, ordered: bool = False
) -> DataFrame:
    """Registry pages (JSON objects with a ``data`` list).

    One page per line splits over many tasks; ``multiline`` takes files that each hold one
    pretty-printed page.  A file that cannot be parsed fails the read.  ``ordered`` adds each page's
    place in the extract, by file name and line, as ``page``.
    """
    reader = spark.read.schema(S.REGISTRY_PAGE).option("mode", "FAILFAST")
    pages = reader.json(path, multiLine=multiline)
    if not ordered:
        return pages
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return pages.select("data", place.alias("page"))


def flatten_pages(pages: DataFrame) -> DataFrame:
    """Registry records of the pages; an absent or null node anywhere on a path gives null.

    Pages that know their ``page`` give records an ``ordinal``, the place in the extract, so that of
    repeated identifiers the last one can win.
    """
    more = []
    if "page" in pages.columns:
        item = pages.select("page", F.posexplode("data").alias("position", "item"))
        more = [F.struct("page", "position").alias("ordinal")]
    else:
        item = pages.select(F.explode("data").alias("item"))
    attributes = F.col("item.attributes")
    return item.select(
        F.col("item.id").alias("lei"),
        attributes["entity"]["legalName"]["name"].alias("name"),
        attributes["entity"]["legalAddress"]["country"].alias("country"),
        attributes["entity"]["legalForm"]["name"].alias("legal_form"),
        attributes["registration"]["status"].alias("status"),
        attributes["registrationAuthority"]["id"].alias("registration_authority"),
        *more,
    )


def current_records(versions: DataFrame, order: str | Column = "ordinal") -> DataFrame:
    """One record per identifier: the one with the greatest ``order``."""
    return last_wins(versions, "lei", order).select(*S.REGISTRY_COLUMNS)


def requested_identifiers(clients: DataFrame) -> DataFrame:
    """The distinct non-empty identifiers of the clients."""
    lei = F.col("entity_lei")
    return clients.where(present(lei)).select(lei.alias("lei")).distinct()


def lookup_batches(requested: DataFrame, size: int = S.LOOKUP_BATCH) -> DataFrame:
    """Identifiers with the number of their request batch, each of at most ``size``."""
    return in_batches(requested, "lei", size).select("lei", "batch")


def lookup(registry: DataFrame, requested: DataFrame) -> DataFrame:
    """The registry records asked for.

    ``requested`` has one row per identifier but grows with the upload, so the choice between
    broadcasting and shuffling it is left to the optimiser's size estimate.
    """
    return registry.join(requested.select("lei"), "lei", "left_semi")


def lookup_one(registry: DataFrame, lei: str) -> DataFrame:
    """The record of one identifier, or no row.  The filter reaches the scan."""
    return registry.where(F.col("lei") == lei).limit(1)
