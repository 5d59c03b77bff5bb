import pytest
from pyspark.sql import functions as F

from concordat.operators import skew
from concordat.operators.validation import (
    match_registry,
    not_found,
    unmatched_clients,
    validate,
    verify_identifiers,
)
from tests.helpers import (
    ACTIVE,
    LAPSED,
    MATCHING,
    MISMATCHED,
    NO_LEI,
    by_id,
    client,
    clients,
    registry,
)


def one(spark, row, *records, **rules):
    return validate(clients(spark, row), registry(spark, *records), **rules).first()


def test_everything_matches(spark):
    row = one(spark, MATCHING, ACTIVE)
    assert row.verification_status == "VERIFIED"
    assert row.name_match and row.country_match and row.legal_form_match
    assert row.quality_score == 1.0 and row.issues == []
    assert (row.gleif_name, row.gleif_country, row.lei_status) == ("Apple Inc.", "US", "ACTIVE")


def test_country_differs(spark):
    row = one(spark, MISMATCHED, ACTIVE)
    assert row.verification_status == "MISMATCH"
    assert row.issues == [
        "Name mismatch: 'Apple Incorporated' vs GLEIF 'Apple Inc.'",
        "Country mismatch: 'UK' vs GLEIF 'US'",
    ]
    assert row.quality_score == 0.4


@pytest.mark.parametrize("lei", [None, ""])
def test_no_identifier(spark, lei):
    row = one(spark, client("C", "Unknown Corp", lei), ACTIVE)
    assert row.verification_status == "MISSING" and row.quality_score == 0.0
    assert row.issues == ["entity_lei is missing"]
    assert (row.name_match, row.country_match, row.legal_form_match) == (False, False, False)


def test_blank_identifier_is_not_missing_but_unknown(spark):
    row = one(spark, client("C", "Unknown Corp", " "), ACTIVE)
    assert row.issues == ["LEI   not found in GLEIF"] and row.quality_score == 0.1


def test_inactive_registration(spark):
    row = one(spark, client("C001", "Defunct Corp Ltd", LAPSED[0], "US", "Corporation"), LAPSED)
    assert row.verification_status == "INACTIVE"
    # The field issues take the place of the status text ...
    assert row.issues == [
        "Country mismatch: 'US' vs GLEIF 'GB'",
        "Legal form mismatch: 'Corporation' vs GLEIF 'Limited'",
    ]
    assert row.quality_score == 0.4
    # ... unless it is asked for.
    kept = one(spark, client("C", "Defunct Corp Ltd", LAPSED[0]), LAPSED, keep_status_issue=True)
    assert kept.issues == ["LEI status is INACTIVE"]


def test_identifier_not_in_registry(spark):
    row = one(spark, MATCHING)
    assert row.verification_status == "MISSING" and row.quality_score == 0.1
    assert row.issues == [f"LEI {ACTIVE[0]} not found in GLEIF"]


def test_identifier_compare_is_exact(spark):
    assert one(spark, client("C", "x", ACTIVE[0].lower()), ACTIVE).quality_score == 0.1
    assert one(spark, client("C", "x", ACTIVE[0] + " "), ACTIVE).quality_score == 0.1


def test_batch_keeps_every_row(spark):
    rows = [MATCHING, MISMATCHED, NO_LEI, MATCHING]
    result = validate(clients(spark, *rows), registry(spark, ACTIVE))
    assert result.count() == 4
    statuses = {row.client_id: row.verification_status for row in result.collect()}
    assert statuses == {"C001": "VERIFIED", "C002": "MISMATCH", "C003": "MISSING"}


def test_partial_client_scores_what_it_supplies(spark):
    row = one(spark, client("C", "Apple Inc.", ACTIVE[0]), ACTIVE)
    assert row.quality_score == 0.6 and row.verification_status == "VERIFIED"


NAMES = [
    ("", "Apple Inc.", True),  # an empty name is part of every name
    (" \t\n", "Apple Inc.", True),
    (None, "Apple Inc.", False),
    ("Apple", "", False),
    ("Apple", None, False),
    ("Apple", "  ", True),  # a blank registered name is given, and empty when cut
    ("\xa0 APPLE inc.\u2003", "Apple Inc.", True),
    ("The Apple Inc. Group", "Apple Inc.", True),
    ("Apple", "The Apple Inc.", True),
    ("Apple Ltd", "Apple Limited", False),
    ("a%b", "xa%by", True),
    ("a_b", "acb", False),
]


def test_names(spark):
    rows = [client(str(i), name, f"L{i}") for i, (name, _, _) in enumerate(NAMES)]
    records = [(f"L{i}", r, None, None, "ACTIVE", None) for i, (_, r, _) in enumerate(NAMES)]
    found = by_id(validate(clients(spark, *rows), registry(spark, *records)))
    assert [found[str(i)].name_match for i in range(len(NAMES))] == [a for _, _, a in NAMES]


def test_null_name_prints_as_none(spark):
    row = one(spark, client("C", None, "L1"), ("L1", None, None, None, None, None))
    assert row.issues == ["Name mismatch: 'None' vs GLEIF 'None'"]


STATUSES = [
    ("ACTIVE", "VERIFIED", 0.6),
    ("active", "VERIFIED", 0.6),
    (None, "VERIFIED", 0.4),  # no status is neither active nor inactive
    ("", "VERIFIED", 0.4),
    (" ACTIVE", "INACTIVE", 0.4),  # not cut before it is compared
    ("LAPSED", "INACTIVE", 0.4),
    ("ISSUED", "INACTIVE", 0.4),
]


def test_registration_status(spark):
    rows = [client(str(i), "a", f"L{i}") for i in range(len(STATUSES))]
    records = [(f"L{i}", "a", None, None, s, None) for i, (s, _, _) in enumerate(STATUSES)]
    found = by_id(validate(clients(spark, *rows), registry(spark, *records)))
    got = [(found[str(i)].verification_status, found[str(i)].quality_score) for i in range(len(rows))]
    assert got == [(verdict, score) for _, verdict, score in STATUSES]


def test_recoding_options(spark):
    record = ("L1", "a", "GB", None, "ISSUED", None)
    row = one(spark, client("C", "a", "L1", "UK"), record)
    assert row.issues == ["Country mismatch: 'UK' vs GLEIF 'GB'"]
    row = one(
        spark,
        client("C", "a", "L1", "UK"),
        record,
        country_alias={"UK": "GB"},
        status_map={"ISSUED": "ACTIVE"},
    )
    assert (row.verification_status, row.quality_score) == ("VERIFIED", 0.8)


def test_supplied_country_against_none_registered(spark):
    row = one(spark, client("C", "a", "L1", "US", " "), ("L1", "a", None, " ", "ACTIVE", None))
    assert row.issues == ["Country mismatch: 'US' vs GLEIF 'None'"]
    assert row.country_match is False and row.legal_form_match is True


def test_bare_identifiers(spark):
    asked = spark.createDataFrame([(ACTIVE[0],), (LAPSED[0],), ("NOPE",)], "lei string")
    rows = by_id(verify_identifiers(asked, registry(spark, ACTIVE, LAPSED)))
    active = rows[ACTIVE[0]]
    assert (active.verification_status, active.quality_score) == ("VERIFIED", 0.6)
    assert active.entity_name == ""
    assert rows[LAPSED[0]].verification_status == "INACTIVE"
    assert rows["NOPE"].quality_score == 0.1


def test_same_identifier_under_two_clients_keeps_both(spark):
    other = client("C023", "Apple Inc.", ACTIVE[0], "US", "Corporation")
    assert validate(clients(spark, MATCHING, other), registry(spark, ACTIVE)).count() == 2


def test_scores_are_whole_tenths_and_rows_are_kept(spark):
    names, leis = ["", None, "Apple Inc.", "Pear"], [None, "", "L1", "L2", "L3", "L9"]
    rows = [
        client(f"{i}-{j}-{k}-{m}", n, lei, c, f)
        for i, n in enumerate(names)
        for j, lei in enumerate(leis)
        for k, c in enumerate([None, "US", "FR"])
        for m, f in enumerate([None, "Inc", "AG"])
    ]
    records = [
        ("L1", "Apple Inc.", "US", "Inc", "ACTIVE", None),
        ("L2", "Apple Inc.", None, "Inc", "LAPSED", None),
        ("L3", None, "US", None, None, None),
    ]
    result = validate(clients(spark, *rows), registry(spark, *records))
    assert result.count() == len(rows)
    scores = {row.quality_score for row in result.select("quality_score").collect()}
    assert scores <= {0.0, 0.1, 0.2, 0.4, 0.6, 0.8, 1.0}


def test_not_found_and_unmatched(spark):
    rows = clients(
        spark,
        MATCHING,
        MISMATCHED,
        NO_LEI,
        client("C4", "x", LAPSED[0]),
        client("C5", "x", "NOPE"),
        client("C6", "x", ""),
    )
    records = registry(spark, ACTIVE, LAPSED)
    assert [r.client_id for r in not_found(rows, records).collect()] == ["C5"]
    found = unmatched_clients(rows, validate(rows, records))
    assert sorted(r.client_id for r in found.collect()) == ["C002", "C003", "C5", "C6"]


def test_shuffled_join_agrees_with_broadcast(spark, shuffled, no_auto_broadcast, monkeypatch):
    """A third of the rows on one identifier, a third without one, exact copies among them."""
    monkeypatch.setattr(shuffled, "MIN_HOT_ROWS", 50)
    rows = spark.range(6000).select(
        F.when(F.col("id") < 3000, "copy").otherwise(F.concat(F.lit("C"), "id")).alias("client_id"),
        F.lit("name").alias("entity_name"),
        F.when(F.col("id") % 3 == 0, "L1")
        .when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("L"), F.col("id") % 40))
        .alias("entity_lei"),
        F.lit("US").alias("country"),
        F.lit(None).cast("string").alias("legal_form"),
    )
    records = spark.range(40).select(
        F.concat(F.lit("L"), "id").alias("lei"),
        F.lit("name").alias("name"),
        F.lit("US").alias("country"),
        F.lit("x").alias("legal_form"),
        F.lit("ACTIVE").alias("status"),
        F.lit("r").alias("registration_authority"),
    )
    hot = shuffled.hot_keys(rows.withColumnRenamed("entity_lei", "k"), "k", 50)
    assert [row.k for row in hot.collect()] == ["L1"]
    matched = match_registry(rows, records)
    assert matched.count() == 6000
    assert matched.where("record.lei = entity_lei").count() == 4000
    assert matched.where("record is null").count() == 2000
    sizes = [
        row["count"]
        for row in matched.groupBy(F.spark_partition_id().alias("p")).count().collect()
    ]
    assert max(sizes) < 3000
    assert unmatched_clients(rows, validate(rows, records)).count() == rows.where(
        "client_id = 'copy' or entity_lei is null"
    ).count()
    unknown = not_found(rows, records.where("lei <> 'L1'"))
    assert unknown.count() == rows.where("entity_lei = 'L1'").count()


def test_many_broadcasts_fit_the_driver(spark):
    rows = spark.range(40_000)
    assert skew.fits_broadcast(rows.withColumn("text", F.repeat(F.lit("x"), 700)))
    assert not skew.fits_broadcast(rows.withColumn("text", F.repeat(F.lit("x"), 1000)))


def test_rows_without_identifier_are_spread(spark, shuffled, no_auto_broadcast):
    """No key is hot here, yet most rows have none; exact copies of one row among them."""
    rows = spark.range(0, 8000, 1, 8).select(
        F.lit("copy").alias("client_id"),
        F.lit("name").alias("entity_name"),
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("L"), "id")).alias("entity_lei"),
        F.lit("US").alias("country"),
        F.lit(None).cast("string").alias("legal_form"),
    )
    matched = match_registry(rows, registry(spark, ACTIVE, LAPSED))
    parts = matched.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(row["count"] for row in parts) == 8000
    assert max(row["count"] for row in parts) < 4000
