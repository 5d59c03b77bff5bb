"""Field checks, status, issues and score of one client row beside its registry record.

All of them are plain column expressions, so a validation is a few projections and no more.
Client columns are read by their own names; the registry record is the struct column ``record``,
null where none was found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat import schemas as S
from concordat.functions.text import normalized, present, shown

# Issue texts.
MISSING_LEI_ISSUE = "entity_lei is missing"
NOT_FOUND_ISSUE = "LEI %s not found in GLEIF"
STATUS_ISSUE = "LEI status is %s"
NAME_ISSUE = "Name mismatch: '%s' vs GLEIF '%s'"
COUNTRY_ISSUE = "Country mismatch: '%s' vs GLEIF '%s'"
LEGAL_FORM_ISSUE = "Legal form mismatch: '%s' vs GLEIF '%s'"
# End of fixed values.


def _recoded(column: Column, mapping: dict[str, str] | None) -> Column:
    """Replace whole values by the given mapping; values outside it stay."""
    if not mapping:
        return column
    pairs = [F.lit(text) for pair in mapping.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), column)


def _text(template: str, *values: Column) -> Column:
    """Fill the ``%s`` places of a template; null prints as ``None``."""
    parts = template.split("%s")
    pieces = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:]):
        pieces += [shown(value), F.lit(part)]
    return F.concat(*pieces)


def texts_that_apply(*cases: tuple[Column, Column]) -> Column:
    """The texts whose condition holds, in the order given."""
    nothing = F.array().cast("array<string>")
    return F.concat(*[F.when(condition, F.array(text)).otherwise(nothing) for condition, text in cases])


def is_missing_lei(lei: Column) -> Column:
    """Null or empty; a blank string counts as given."""
    return ~present(lei)


def is_inactive(status: Column) -> Column:
    """A registration status that is given and is not the active one, whatever its case."""
    return present(status) & (F.upper(status) != S.ACTIVE_REGISTRATION)


def is_active(status: Column) -> Column:
    return present(status) & (F.upper(status) == S.ACTIVE_REGISTRATION)


def _same(ours: Column, theirs: Column) -> Column:
    """Both given and equal; text that is equal as it stands needs no normalising."""
    equal = (ours == theirs) | (normalized(ours) == normalized(theirs))
    return present(ours) & present(theirs) & equal


def checked(
    matched: DataFrame,
    keep: tuple[str, ...] = (),
    *,
    country_alias: dict[str, str] | None = None,
    status_map: dict[str, str] | None = None,
    keep_status_issue: bool = False,
) -> DataFrame:
    """Result columns, in the order of ``schemas.RESULT``, for client rows beside their ``record``.

    ``keep`` names columns to carry along.  ``country_alias`` recodes client countries before they
    are compared, ``status_map`` recodes registration statuses, and ``keep_status_issue`` keeps the
    text on an inactive registration, which the field issues otherwise replace.

    The rules on one field: a client's name agrees with a registered one when either contains the
    other, so an empty name agrees with every registered name and a null one with none; country and
    legal form agree when both are given and equal.  All comparisons are of normalised text.
    """
    lei, name, record = F.col("entity_lei"), F.col("entity_name"), F.col("record")
    country, form = F.col("country"), F.col("legal_form")
    registered = record["name"]
    # Two narrow projections before the wide one: each name is normalised once, and only where the
    # two differ as they stand.
    prepared = matched.withColumns(
        {
            "__ours": F.when(name != registered, normalized(name)),
            "__theirs": F.when(name != registered, normalized(registered)),
            "__status": _recoded(record["status"], status_map),
        }
    )
    ours, theirs = F.col("__ours"), F.col("__theirs")
    agrees = (name == registered) | theirs.contains(ours) | ours.contains(theirs)
    flagged = prepared.withColumns(
        {
            "name_match": name.isNotNull() & present(registered) & agrees,
            "country_match": _same(_recoded(country, country_alias), record["country"]),
            "legal_form_match": _same(form, record["legal_form"]),
            "__missing": is_missing_lei(lei),
            "__inactive": is_inactive(F.col("__status")),
            "__active": is_active(F.col("__status")),
        }
    )
    missing, unknown, status = F.col("__missing"), record.isNull(), F.col("__status")
    name_fails = ~F.col("name_match")
    country_fails = present(country) & ~F.col("country_match")
    form_fails = present(form) & ~F.col("legal_form_match")
    cases = [
        (name_fails, _text(NAME_ISSUE, name, registered)),
        (country_fails, _text(COUNTRY_ISSUE, country, record["country"])),
        (form_fails, _text(LEGAL_FORM_ISSUE, form, record["legal_form"])),
    ]
    if keep_status_issue:
        cases.insert(0, (F.col("__inactive"), _text(STATUS_ISSUE, status)))

    verdict = (
        F.when(missing | unknown, S.MISSING)
        .when(F.col("__inactive"), S.INACTIVE)
        .when(name_fails | country_fails | form_fails, S.MISMATCH)
        .otherwise(S.VERIFIED)
    )
    issues = (
        F.when(missing, F.array(F.lit(MISSING_LEI_ISSUE)))
        .when(unknown, F.array(_text(NOT_FOUND_ISSUE, lei)))
        .otherwise(texts_that_apply(*cases))
    )
    weights = {
        "name_match": S.NAME_TENTHS,
        "country_match": S.COUNTRY_TENTHS,
        "legal_form_match": S.LEGAL_FORM_TENTHS,
        "__active": S.ACTIVE_TENTHS,
    }
    earned = sum((F.when(F.col(flag), w).otherwise(0) for flag, w in weights.items()), F.lit(0))
    tenths = F.when(missing, 0).when(unknown, S.NOT_FOUND_TENTHS).otherwise(earned)
    return flagged.select(
        "client_id",
        "entity_lei",
        "entity_name",
        verdict.alias("verification_status"),
        "name_match",
        "country_match",
        "legal_form_match",
        status.alias("lei_status"),
        issues.alias("issues"),
        registered.alias("gleif_name"),
        record["country"].alias("gleif_country"),
        (tenths.cast("double") / 10).alias("quality_score"),
        *keep,
    )
