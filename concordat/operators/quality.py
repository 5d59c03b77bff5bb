"""Quality reports over validation results.  Each is one aggregate over one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat import schemas as S
from concordat.functions.checks import texts_that_apply
from concordat.functions.text import present

# Alert texts.
SCORE_ALERT = "Overall quality below threshold: "
MISSING_ALERT = ("High missing rate: ", " records have no LEI")
INACTIVE_ALERT = ("Inactive LEIs detected: ", " records")
# End of fixed values.


def status_counts() -> list[Column]:
    """Aggregates for the report's counts; unverified rows count as missing."""
    status = F.col("verification_status")
    return [
        F.count("*").alias("total_records"),
        F.count_if(status == S.VERIFIED).alias("verified"),
        F.count_if(status == S.MISMATCH).alias("mismatched"),
        F.count_if(status == S.INACTIVE).alias("inactive"),
        F.count_if(status.isin(S.MISSING, S.UNVERIFIED)).alias("missing"),
    ]


def overall_score() -> Column:
    """Mean score to four places, 0.0 over nothing.

    Scores are whole tenths, so their sum is taken in integers and does not depend on the order
    of rows.
    """
    tenths = F.sum(F.round(F.col("quality_score") * 10).cast("bigint"))
    return F.coalesce(F.round(F.try_divide(tenths, F.count("quality_score") * 10), 4), F.lit(0.0))


def filled_share(column: str) -> Column:
    """Share of rows with a non-empty value, to three places."""
    return F.round(F.try_divide(F.count_if(present(F.col(column))), F.count("*")), 3)


def non_null_share(column: str) -> Column:
    """Share of rows with any value, empty ones included, to three places; 0.0 over nothing."""
    nulls = F.count("*") - F.count(column)
    return F.coalesce(F.round(F.lit(1.0) - F.try_divide(nulls, F.count("*")), 3), F.lit(0.0))


def percent_text(share: Column) -> Column:
    """A share of four places as a percentage of one, half rounded up."""
    tenths = F.floor((F.round(share * 10000) + 5) / 10).cast("bigint")
    whole, rest = F.floor(tenths / 10).cast("string"), (tenths % 10).cast("string")
    return F.concat(whole, F.lit("."), rest, F.lit("%"))


def alerts() -> Column:
    """Alert texts for a row of counts and the overall score; all limits are strict."""
    total, missing, inactive = F.col("total_records"), F.col("missing"), F.col("inactive")
    score = F.col("overall_quality_score")
    missing_text = F.concat(
        F.lit(MISSING_ALERT[0]),
        missing.cast("string"),
        F.lit("/"),
        total.cast("string"),
        F.lit(MISSING_ALERT[1]),
    )
    inactive_text = F.concat(
        F.lit(INACTIVE_ALERT[0]), inactive.cast("string"), F.lit(INACTIVE_ALERT[1])
    )
    some = total > 0
    return texts_that_apply(
        (some & (score < S.MIN_OVERALL_SCORE), F.concat(F.lit(SCORE_ALERT), percent_text(score))),
        (F.try_divide(missing, total) > S.MAX_MISSING_SHARE, missing_text),
        (F.try_divide(inactive, total) > S.MAX_INACTIVE_SHARE, inactive_text),
    )


# Fields whose completeness the report of the whole table gives.
_SHARED_FIELDS = {"lei": "entity_lei", "name": "gleif_name", "country": "gleif_country"}
_REPORT_COUNTS = ("total_records", "verified", "mismatched", "inactive", "missing")


def batch_report(results: DataFrame) -> DataFrame:
    """One-row report of a batch of results, with alerts.

    An empty batch gives zeros and no completeness.
    """
    filled = {"lei": "entity_lei", "gleif_name": "gleif_name", "gleif_country": "gleif_country"}
    shares = [filled_share(column).alias(f"share_{name}") for name, column in filled.items()]
    totals = results.agg(
        *status_counts(), overall_score().alias("overall_quality_score"), *shares
    )
    entries = F.array(
        *[F.struct(F.lit(n).alias("k"), F.col(f"share_{n}").alias("v")) for n in filled]
    )
    measured = F.filter(entries, lambda entry: F.col("total_records") > 0)
    return totals.select(
        *_REPORT_COUNTS,
        "overall_quality_score",
        F.map_from_entries(measured).alias("field_completeness"),
        alerts().alias("issues_summary"),
    )


def store_report(curated: DataFrame) -> DataFrame:
    """One-row report of the whole curated table.

    Completeness here asks for any value, so an empty text counts as present, unlike in
    ``batch_report``; there are no alerts.
    """
    shares = [non_null_share(c).alias(f"share_{name}") for name, c in _SHARED_FIELDS.items()]
    totals = curated.agg(
        *status_counts(), overall_score().alias("overall_quality_score"), *shares
    )
    pairs = [part for name in _SHARED_FIELDS for part in (F.lit(name), F.col(f"share_{name}"))]
    return totals.select(
        *_REPORT_COUNTS,
        "overall_quality_score",
        F.create_map(*pairs).alias("field_completeness"),
        F.array().cast("array<string>").alias("issues_summary"),
    )


def partials(curated: DataFrame, *keys: str) -> DataFrame:
    """Additive totals per ``keys``, country and status, from which reports and marts are merged."""
    given = [F.count(column).alias(f"given_{name}") for name, column in _SHARED_FIELDS.items()]
    return curated.groupBy(*keys, "gleif_country", "verification_status").agg(
        F.count("*").alias("records"),
        F.count("quality_score").alias("scored"),
        F.coalesce(F.sum(F.round(F.col("quality_score") * 10).cast("bigint")), F.lit(0)).alias("tenths"),
        *given,
    )


def report_of(totals: DataFrame) -> DataFrame:
    """``store_report`` from the totals of ``partials`` in place of the rows."""
    status, records = F.col("verification_status"), F.col("records")

    def rows(wanted: Column | None = None) -> Column:
        counted = records if wanted is None else F.when(wanted, records)
        return F.coalesce(F.sum(counted), F.lit(0))

    def share(name: str) -> Column:
        nulls = rows() - F.coalesce(F.sum(f"given_{name}"), F.lit(0))
        return F.coalesce(F.round(F.lit(1.0) - F.try_divide(nulls, rows()), 3), F.lit(0.0))

    score = F.round(F.try_divide(F.sum("tenths"), F.sum("scored") * 10), 4)
    pairs = [part for name in _SHARED_FIELDS for part in (F.lit(name), share(name))]
    return totals.agg(
        rows().alias("total_records"),
        rows(status == S.VERIFIED).alias("verified"),
        rows(status == S.MISMATCH).alias("mismatched"),
        rows(status == S.INACTIVE).alias("inactive"),
        rows(status.isin(S.MISSING, S.UNVERIFIED)).alias("missing"),
        F.coalesce(score, F.lit(0.0)).alias("overall_quality_score"),
        F.create_map(*pairs).alias("field_completeness"),
        F.array().cast("array<string>").alias("issues_summary"),
    )


def mart_of(totals: DataFrame) -> DataFrame:
    """Rows and mean score by country and status, from the totals of ``partials``."""
    return totals.groupBy("gleif_country", "verification_status").agg(
        F.sum("records").alias("records"),
        F.round(F.sum("tenths") / (F.sum("records") * 10), 4).alias("mean_score"),
    )


def history_row(report: DataFrame, run_id: str, run_at: Column) -> DataFrame:
    """The report as a row of the quality history."""
    return report.select(
        F.lit(run_id).alias("run_id"),
        run_at.cast("timestamp").alias("run_at"),
        *_REPORT_COUNTS,
        F.col("overall_quality_score").alias("overall_score"),
    )


def run_metrics(results: DataFrame) -> DataFrame:
    """Result rows per status."""
    return results.groupBy("verification_status").agg(F.count("*").alias("records"))


def resolution_rate(resolutions: DataFrame) -> DataFrame:
    """Clients resolved, those matched with confidence, and their share (0.0 over nothing)."""
    sure = F.count_if(F.col("match_score") >= S.MIN_CONFIDENCE)
    return resolutions.agg(
        F.count("*").alias("total"),
        sure.alias("resolved"),
        F.coalesce(F.try_divide(sure, F.count("*")), F.lit(0.0)).alias("rate"),
    )
