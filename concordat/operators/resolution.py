"""Resolving clients to their nearest registry records.

Three ways, best first: an answered re-ranking of vector candidates, the top vector candidate,
and the most similar name.  The outcome of each way is a struct of record, score and method.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat import schemas as S
from concordat.functions.checks import texts_that_apply
from concordat.functions.text import present, shown, token_sort_key
from concordat.operators.name_search import best_names
from concordat.operators.ordinal import in_batches
from concordat.operators.skew import lookup_join
from concordat.session import materialize

# Method names and issue texts.
RERANKED = "rag_llm"
EMBEDDING = "embedding"
FUZZY = "fuzzy"
NO_INDEX = "no_index"
NO_CANDIDATES = "embedding_no_candidates"
NO_METHOD = "no_method"
LOW_CONFIDENCE_ISSUE = "Low match confidence: %.2f"
NO_MATCH_ISSUE = "No match found"
# End of fixed values.

_KEY = "__key"


def _record() -> Column:
    return F.struct(*S.REGISTRY_COLUMNS).alias("record")


def _no_record() -> Column:
    return F.lit(None).cast(S.REGISTRY)


def outcome(record: Column, score: Column, method: Column) -> Column:
    return F.struct(
        record.alias("record"), score.cast("double").alias("score"), method.alias("method")
    )


def by_name(clients: DataFrame, registry: DataFrame, min_score: float = 0.0) -> DataFrame:
    """Add ``by_name``: the most similar registry name among all; ties go to the lowest
    identifier.  No similarity at all, or none of ``min_score`` (0 to 1), leaves the record null at
    score 0."""
    keyed = clients.withColumn(_KEY, token_sort_key(F.col("entity_name")))
    names = registry.select(token_sort_key(F.col("name")).alias("key"), F.col("lei").alias("id"))
    least = max(1, math.ceil(round(min_score * 100, 6)))
    found = best_names(keyed.select(F.col(_KEY).alias("key")), names, least)
    records = registry.select(F.col("lei").alias("id"), _record())
    # Many names may share one best record; one name may belong to many clients.
    matched = lookup_join(found, records, "id", "left").select(
        F.col("key").alias(_KEY), F.col("score").alias("__score"), F.col("record").alias("__record")
    )
    any_record = registry.limit(1).agg(F.count("*").alias("n")).scalar() > 0
    fuzzy = outcome(
        F.col("__record"),
        F.coalesce(F.col("__score") / 100, F.lit(0.0)),
        F.when(any_record, FUZZY).otherwise(NO_METHOD),
    )
    return lookup_join(keyed, matched, _KEY, "left").select(
        *clients.columns, fuzzy.alias("by_name")
    )


def candidate_lists(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per client with its few ranked candidates as an array.

    ``candidates`` comes from ``top_vectors``: at most ``k`` rows per client.  Candidates whose
    identifier the registry no longer has are left out, and those after them move up.
    """
    records = registry.select(F.col("lei").alias("id"), _record())
    listed = lookup_join(candidates, records, "id", "left").where(F.col("record").isNotNull())
    entry = F.struct("rank", "score", "record")
    return listed.groupBy(F.col("query_id").alias("client_id")).agg(
        F.sort_array(F.collect_list(entry)).alias("candidates")
    )


def client_line(name: Column, country: Column, legal_form: Column) -> Column:
    """How a request names the client that is to be matched."""

    def known(value: Column) -> Column:
        return F.when(present(value), value).otherwise("unknown")

    return F.format_string(
        '"%s" (country: %s, legal form: %s)', shown(name), known(country), known(legal_form)
    )


def rerank_requests(lists: DataFrame, clients: DataFrame) -> DataFrame:
    """What a re-ranker is asked: the client and its numbered candidate lines, one row per client.

    ``clients`` has one row per client id; clients that it lacks are asked about without a line.
    """

    def line(entry: Column, place: Column) -> Column:
        record = entry["record"]
        fields = [shown(record[name]) for name in ("name", "country", "legal_form", "lei")]
        number = (place + 1).cast("string")
        return F.concat(number, F.lit(". "), F.concat_ws(" | ", *fields))

    about = clients.select(
        "client_id",
        client_line(F.col("entity_name"), F.col("country"), F.col("legal_form")).alias("client_line"),
    )
    lines = F.array_join(F.transform("candidates", line), "\n")
    return lists.join(about, "client_id", "left").select(
        "client_id", "client_line", F.size("candidates").alias("n"), lines.alias("candidate_list")
    )


def _kind(value: Column) -> Column:
    """Type name of a variant, with its precision or content cut off."""
    return F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0)


def read_answer(answer: Column, candidates: Column) -> Column:
    """What a re-ranker's answer says: struct ``usable``, ``choice`` (0 for none), ``confidence``.

    An answer is unusable when it is not a JSON object, chooses by something other than a whole
    number, or gives a confidence that is not a number.  No choice, 0 or a choice out of range
    means "none of them"; an absent confidence counts as 0.0.
    """
    parsed = F.try_parse_json(answer)
    is_object = F.coalesce(_kind(parsed) == "OBJECT", F.lit(False))
    match = F.try_variant_get(parsed, "$.match", "variant")
    confidence = F.try_variant_get(parsed, "$.confidence", "variant")
    match_kind = F.coalesce(_kind(match), F.lit("VOID"))
    confidence_kind = F.coalesce(_kind(confidence), F.lit("ABSENT"))

    # Texts and lists name no candidate; only when empty do they say "none".
    number = F.try_variant_get(parsed, "$.match", "double")
    whole = match_kind.isin("BIGINT", "BOOLEAN")
    blank = (
        (match_kind == "VOID")
        | ((match_kind == "STRING") & (F.try_variant_get(parsed, "$.match", "string") == ""))
        | F.coalesce(F.schema_of_variant(match).isin("OBJECT<>", "ARRAY<VOID>"), F.lit(False))
    )
    fraction = match_kind.isin("DECIMAL", "DOUBLE", "FLOAT")
    in_range = number.between(1, F.size(candidates))
    choice_ok = blank | whole | (fraction & ~in_range)
    choice = F.when(whole & in_range, number.cast("int")).otherwise(0)

    # A number written as text is read; any other text, null, list or object is not a number.
    amount = F.try_variant_get(parsed, "$.confidence", "double")
    amount_ok = F.when(confidence_kind == "ABSENT", True).otherwise(
        confidence_kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN", "STRING")
        & amount.isNotNull()
    )
    usable = is_object & choice_ok & amount_ok
    return F.struct(
        F.coalesce(usable, F.lit(False)).alias("usable"),
        F.coalesce(choice, F.lit(0)).alias("choice"),
        F.coalesce(amount, F.lit(0.0)).alias("confidence"),
    )


def by_vector(lists: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Per client the outcome ``by_vector`` of its candidates.

    With ``answers`` (``client_id``, ``answer``; one row per client) a usable answer decides, even
    when it chooses none; without one, or with an unusable one, the first candidate stands.
    """
    first = F.try_element_at("candidates", F.lit(1))
    top = F.when(
        F.size("candidates") > 0, outcome(first["record"], first["score"], F.lit(EMBEDDING))
    ).otherwise(outcome(_no_record(), F.lit(0.0), F.lit(NO_CANDIDATES)))
    if answers is None:
        return lists.select("client_id", top.alias("by_vector"))
    read = read_answer(F.col("answer"), F.col("candidates"))
    told = lists.join(answers.select("client_id", "answer"), "client_id", "left").withColumn(
        "__read", read
    )
    usable, choice = F.col("__read.usable"), F.col("__read.choice")
    chosen = F.when(choice > 0, F.try_element_at("candidates", choice))
    reranked = outcome(
        chosen["record"],
        F.when(choice > 0, F.col("__read.confidence")).otherwise(0.0),
        F.lit(RERANKED),
    )
    decided = F.when(usable & (F.size("candidates") > 0), reranked).otherwise(top)
    return told.select("client_id", decided.alias("by_vector"))


def finish(clients: DataFrame, *ways: str, otherwise: str = NO_METHOD) -> DataFrame:
    """Resolution rows from the first of the outcome columns ``ways`` that is not null.

    The best match is kept however low its score; a low score only adds an issue.
    """
    fallback = outcome(_no_record(), F.lit(0.0), F.lit(otherwise))
    picked = F.coalesce(*[F.col(way) for way in ways], fallback)
    client = F.struct(*[name for name in S.CLIENT_COLUMNS if name in clients.columns])
    rows = clients.select(client.alias("client_entity"), picked.alias("__picked"))
    score = F.col("__picked.score")
    issues = texts_that_apply(
        (score < S.MIN_CONFIDENCE, F.format_string(LOW_CONFIDENCE_ISSUE, score)),
        (F.col("__picked.record").isNull(), F.lit(NO_MATCH_ISSUE)),
    )
    return rows.select(
        "client_entity",
        F.col("__picked.record").alias("matched_legal_entity"),
        F.round(score, 4).alias("match_score"),
        F.col("__picked.method").alias("match_method"),
        issues.alias("issues"),
    )


def resolve(
    clients: DataFrame,
    registry: DataFrame,
    candidates: DataFrame | None = None,
    answers: DataFrame | None = None,
    names: bool = True,
    min_score: float = 0.0,
) -> DataFrame:
    """Resolve every client row against the whole registry.

    With ``candidates`` (``query_id`` holding client ids, from ``top_vectors``) the vector ways
    are used and name similarity serves the clients that have none; without, name similarity
    alone.  Without ``names`` such clients stay open: as having no candidates, or no index to
    search where ``candidates`` are not given at all.  Name similarity below ``min_score`` is no
    match; by default the best name stands however low its score.
    """
    if candidates is None:
        if not names:
            return finish(clients, otherwise=NO_INDEX)
        return finish(by_name(clients, registry, min_score), "by_name")
    found = materialize(by_vector(candidate_lists(candidates, registry), answers))
    seen = lookup_join(clients, found, "client_id", "left")
    if not names:
        return finish(seen, "by_vector", otherwise=NO_CANDIDATES)
    # Outcomes by name are only worked out for the clients that need them.
    rest = by_name(seen.where(F.col("by_vector").isNull()).drop("by_vector"), registry, min_score)
    resolved = seen.where(F.col("by_vector").isNotNull())
    return finish(resolved, "by_vector").unionByName(finish(rest, "by_name"))


def entity_context(entities: DataFrame, lines: int = S.LOOKUP_BATCH) -> DataFrame:
    """Text lines on registry records for a question-answering prompt.

    Records are taken in identifier order and cut into chunks of at most ``lines``, so no row
    grows with the registry; the chunks in order hold every record.
    """
    facts = [shown(F.col(name)) for name in ("name", "country", "status")]
    text = F.concat(F.col("lei"), F.lit(": "), F.concat_ws(", ", *facts))
    numbered = in_batches(entities.select("lei", text.alias("line")), "lei", lines, "chunk")
    entry = F.sort_array(F.collect_list(F.struct("ordinal", "line")))
    return numbered.groupBy("chunk").agg(
        F.count("*").alias("n_lines"),
        F.array_join(F.transform(entry, lambda e: e["line"]), "\n").alias("context"),
    )
