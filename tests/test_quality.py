from pyspark.sql import functions as F

from concordat import schemas as S
from concordat.operators.quality import (
    alerts,
    batch_report,
    history_row,
    percent_text,
    resolution_rate,
    run_metrics,
    store_report,
)
from concordat.operators.validation import validate
from tests.helpers import ACTIVE, MATCHING, at, client, clients, registry


def results(spark, *rows):
    """Result rows from (id, status, lei, registry name, registry country, score)."""
    filled = [
        (i, lei, "n", status, False, False, False, None, [], name, country, score)
        for i, status, lei, name, country, score in rows
    ]
    return spark.createDataFrame(filled, S.RESULT)


def test_perfect_batch(spark):
    report = batch_report(validate(clients(spark, MATCHING), registry(spark, ACTIVE))).first()
    assert report.overall_quality_score == 1.0
    assert (report.verified, report.total_records) == (1, 1)
    assert report.issues_summary == []
    assert report.field_completeness == {"lei": 1.0, "gleif_name": 1.0, "gleif_country": 1.0}


def test_ten_missing(spark):
    rows = [client(f"C{i}", f"Entity {i}") for i in range(10)]
    report = batch_report(validate(clients(spark, *rows), registry(spark))).first()
    assert (report.overall_quality_score, report.missing) == (0.0, 10)
    assert report.issues_summary == [
        "Overall quality below threshold: 0.0%",
        "High missing rate: 10/10 records have no LEI",
    ]


def test_empty_batch_and_store(spark):
    report = batch_report(results(spark)).first()
    assert report[:5] == (0, 0, 0, 0, 0) and report.overall_quality_score == 0.0
    assert report.field_completeness == {} and report.issues_summary == []
    report = store_report(results(spark)).first()
    assert report[:5] == (0, 0, 0, 0, 0) and report.overall_quality_score == 0.0
    assert report.field_completeness == {"lei": 0.0, "name": 0.0, "country": 0.0}


def test_the_two_reports_differ_on_empty_text(spark):
    rows = results(
        spark,
        ("A", "VERIFIED", "L1", "", "US", 1.0),
        ("B", "UNVERIFIED", "", None, "", 0.0),
        ("C", "MISSING", None, "n", "", 0.1),
    )
    batch, store = batch_report(rows).first(), store_report(rows).first()
    assert batch.field_completeness == {"lei": 0.333, "gleif_name": 0.333, "gleif_country": 0.333}
    assert store.field_completeness == {"lei": 0.667, "name": 0.667, "country": 1.0}
    assert batch.missing == store.missing == 2
    assert batch.overall_quality_score == store.overall_quality_score == 0.3667
    assert store.issues_summary == []


def test_limits_are_strict(spark):
    def told(total, missing, inactive, score):
        row = spark.sql(
            f"select {total}L total_records, {missing}L missing, {inactive}L inactive,"
            f" {score}D overall_quality_score"
        )
        return row.select(alerts()).first()[0]

    assert told(20, 2, 1, 0.7) == []
    assert told(20, 3, 2, 0.6999) == [
        "Overall quality below threshold: 70.0%",
        "High missing rate: 3/20 records have no LEI",
        "Inactive LEIs detected: 2 records",
    ]


def test_percent_text(spark):
    shares = [0.0, 0.55, 0.5525, 0.5524, 0.0005, 0.0004, 1.0, 0.69995]
    rows = spark.createDataFrame([(s,) for s in shares], "s double")
    got = [row[0] for row in rows.select(percent_text(F.col("s"))).collect()]
    assert got == ["0.0%", "55.0%", "55.3%", "55.2%", "0.1%", "0.0%", "100.0%", "70.0%"]


def test_history_and_metrics(spark):
    rows = results(spark, ("A", "VERIFIED", "L", "n", "c", 1.0), ("B", "INACTIVE", "L", "n", "c", 0.4))
    row = history_row(batch_report(rows), "r1", at()).first()
    assert row.run_id == "r1" and row[2:] == (2, 1, 0, 1, 0, 0.7)
    assert {tuple(r) for r in run_metrics(rows).collect()} == {("VERIFIED", 1), ("INACTIVE", 1)}


def test_resolution_rate(spark):
    scores = spark.createDataFrame([(0.8,), (0.79,), (1.0,), (0.0,)], "match_score double")
    assert resolution_rate(scores).first() == (4, 2, 0.5)
    assert resolution_rate(scores.limit(0)).first() == (0, 0, 0.0)
