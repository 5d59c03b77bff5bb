"""Matching clients to registry records by identifier and checking them field by field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat import schemas as S
from concordat.functions.checks import checked, is_missing_lei
from concordat.functions.text import present
from concordat.operators.skew import lookup_join
from concordat.session import materialize

_KEY = "__lei"
_COMPARED = ("name", "country", "legal_form", "status")


def match_registry(
    clients: DataFrame, registry: DataFrame, fields: tuple[str, ...] = S.REGISTRY_COLUMNS
) -> DataFrame:
    """Every client row with its registry record as struct ``record``, null where none is found.

    Only the named ``fields`` of the record are read.

    ``registry`` has one row per identifier (see ``sources.registry.current_records``).  Rows
    without an identifier match nothing and never meet in one partition.
    """
    keyed = clients.withColumn(_KEY, F.when(present(F.col("entity_lei")), F.col("entity_lei")))
    records = registry.where(F.col("lei").isNotNull()).select(
        F.col("lei").alias(_KEY), F.struct(*fields).alias("record")
    )
    return lookup_join(keyed, records, _KEY, "left").drop(_KEY)


def validate(
    clients: DataFrame, registry: DataFrame, keep: tuple[str, ...] = (), **rules
) -> DataFrame:
    """Result row for every client row, duplicates included.

    ``keep`` names client columns to carry along; ``rules`` are those of ``checked``.
    """
    return checked(match_registry(clients, registry, _COMPARED), keep, **rules)


def verify_identifiers(identifiers: DataFrame, registry: DataFrame, **rules) -> DataFrame:
    """Check bare identifiers (column ``lei``): the identifier stands in for the client id, the
    name is empty and nothing else is supplied."""
    nothing = F.lit(None).cast("string")
    clients = identifiers.select(
        F.col("lei").alias("client_id"),
        F.lit("").alias("entity_name"),
        F.col("lei").alias("entity_lei"),
        nothing.alias("country"),
        nothing.alias("legal_form"),
    )
    return validate(clients, registry, **rules)


def not_found(clients: DataFrame, registry: DataFrame) -> DataFrame:
    """Client rows with an identifier the registry does not know."""
    given = clients.where(~is_missing_lei(F.col("entity_lei")))
    known = registry.select(F.col("lei").alias("entity_lei"))
    return lookup_join(given, known, "entity_lei", "left_anti").select(clients.columns)


def unmatched_clients(clients: DataFrame, results: DataFrame) -> DataFrame:
    """Client rows whose id has a result that calls for resolution; inactive ones do not."""
    open_results = results.where(F.col("verification_status").isin(*S.UNMATCHED))
    wanted = materialize(open_results.select("client_id").distinct())
    return lookup_join(clients, wanted, "client_id", "left_semi").select(clients.columns)
