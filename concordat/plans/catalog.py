"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat import schemas as S
from concordat.functions.checks import is_inactive, is_missing_lei
from concordat.functions.text import normalized, token_sort_key, token_sort_ratio
from concordat.functions.vectors import fit_name_vectors, name_vectors, unit, weighted_name_vectors
from concordat.operators import curated as C
from concordat.operators import quality as Q
from concordat.operators import registry_views as V
from concordat.operators import resolution as R
from concordat.operators.name_search import best_names
from concordat.operators.nearest import top_vectors
from concordat.operators.ordinal import in_batches
from concordat.operators.validation import (
    match_registry,
    not_found,
    unmatched_clients,
    validate,
    verify_identifiers,
)
from concordat.plans.fixtures import fixture, table
from concordat.plans.verification import run_daily, run_upload
from concordat.session import materialize, run_folder
from concordat.sources import registry as G
from concordat.sources.staging import latest_staged
from concordat.sources.upload import read_upload, rejected, to_clients
from concordat.streaming.verification import verify_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

RUN_AT = "2024-02-01 00:00:00"
LATER = "2024-02-02 00:00:00"
POINT_LOOKUP = "LEI00000000000000042"


def query(function: Query) -> Query:
    """Register a query; a trailing underscore keeps its name apart from an imported helper."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def joined(texts: str | Column) -> Column:
    return F.array_join(texts, "\n")


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _flat_results(results: DataFrame, *more: Column) -> DataFrame:
    return results.withColumn("issues", joined("issues")).select(*S.RESULT_COLUMNS, *more)


def _results(spark: SparkSession, sf_dir: str, clients: str = "client") -> DataFrame:
    return validate(fixture(spark, sf_dir, clients), fixture(spark, sf_dir, "registry"))


# --- uploads and the registry ------------------------------------------------------------------


@query
def ingest_normalized(spark, sf_dir):
    return to_clients(fixture(spark, sf_dir, "upload_raw"))


@query
def staged_latest(spark, sf_dir):
    rows = latest_staged(fixture(spark, sf_dir, "staged"))
    return rows.select("client_id", "entity_name", "entity_lei", _time("ingested_at"))


@query
def registry_flatten(spark, sf_dir):
    """Registry pages as JSON text, parsed and flattened again."""
    flat = fixture(spark, sf_dir, "registry")
    record = F.struct(
        F.col("lei").alias("id"),
        F.struct(
            F.struct(
                F.struct("name").alias("legalName"),
                F.struct("country").alias("legalAddress"),
                F.struct(F.col("legal_form").alias("name")).alias("legalForm"),
            ).alias("entity"),
            F.struct("status").alias("registration"),
            F.struct(F.col("registration_authority").alias("id")).alias("registrationAuthority"),
        ).alias("attributes"),
    )
    paged = in_batches(flat, "lei", S.LOOKUP_BATCH, "page")
    pages = paged.groupBy("page").agg(F.collect_list(record).alias("data"))
    text = pages.select(F.to_json(F.struct("data")).alias("text"))
    parsed = text.select(F.from_json("text", S.REGISTRY_PAGE).alias("page")).select("page.data")
    return G.flatten_pages(parsed)


@query
def requested_leis(spark, sf_dir):
    return G.requested_identifiers(fixture(spark, sf_dir, "client_large"))


@query
def lei_batches(spark, sf_dir):
    return G.lookup_batches(G.requested_identifiers(fixture(spark, sf_dir, "client")))


@query
def registry_lookup(spark, sf_dir):
    requested = G.requested_identifiers(fixture(spark, sf_dir, "client_large"))
    return G.lookup(fixture(spark, sf_dir, "registry"), requested)


@query
def lei_point_lookup(spark, sf_dir):
    return G.lookup_one(fixture(spark, sf_dir, "registry"), POINT_LOOKUP)


@query
def registry_last_wins(spark, sf_dir):
    return G.current_records(fixture(spark, sf_dir, "registry_versions"))


# --- matching and checking ---------------------------------------------------------------------


@query
def client_registry_join(spark, sf_dir):
    matched = match_registry(
        fixture(spark, sf_dir, "client_large"), fixture(spark, sf_dir, "registry")
    )
    return matched.select(
        "client_id",
        "entity_lei",
        F.col("record.lei").alias("lei"),
        F.col("record.name").alias("name"),
        F.col("record.status").alias("status"),
    )


@query
def lei_not_found(spark, sf_dir):
    clients, registry = fixture(spark, sf_dir, "client"), fixture(spark, sf_dir, "registry")
    return not_found(clients, registry).select("client_id", "entity_lei")


@query
def unmatched_clients_(spark, sf_dir):
    clients = fixture(spark, sf_dir, "client")
    return unmatched_clients(clients, validate(clients, fixture(spark, sf_dir, "registry")))


@query
def missing_lei(spark, sf_dir):
    clients = fixture(spark, sf_dir, "client_large")
    return clients.where(is_missing_lei(F.col("entity_lei"))).select("client_id", "entity_lei")


@query
def normalized_names(spark, sf_dir):
    clients = fixture(spark, sf_dir, "client_large")
    return clients.select("client_id", normalized(F.col("entity_name")).alias("name"))


@query
def name_match_flags(spark, sf_dir):
    return _results(spark, sf_dir).select("client_id", "name_match")


@query
def field_match_flags(spark, sf_dir):
    return _results(spark, sf_dir).select("client_id", "country_match", "legal_form_match")


@query
def inactive_leis(spark, sf_dir):
    registry = fixture(spark, sf_dir, "registry")
    return registry.where(is_inactive(F.col("status"))).select("lei", "status")


@query
def validation_issues(spark, sf_dir):
    return _results(spark, sf_dir).select("client_id", joined("issues").alias("issues"))


@query
def verification_status(spark, sf_dir):
    return _results(spark, sf_dir).select("client_id", "verification_status")


@query
def quality_score(spark, sf_dir):
    return _results(spark, sf_dir).select("client_id", "quality_score")


@query
def validate_entities(spark, sf_dir):
    return _flat_results(_results(spark, sf_dir, "client_large"))


@query
def verify_lei_batch(spark, sf_dir):
    asked = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("LEI"), F.lpad(F.col("o_custkey").cast("string"), 17, "0")).alias("lei")
    )
    return _flat_results(verify_identifiers(asked, fixture(spark, sf_dir, "registry")))


@query
def status_score_counts(spark, sf_dir):
    """The flagship: validated clients counted by status and score."""
    return (
        _results(spark, sf_dir)
        .groupBy("verification_status", "quality_score")
        .agg(F.count("*").alias("records"))
    )


# --- reports -----------------------------------------------------------------------------------


def _flat_report(report: DataFrame, *fields: str) -> DataFrame:
    shares = [F.col("field_completeness")[name].alias(f"{name}_completeness") for name in fields]
    return report.select(
        "total_records",
        "verified",
        "mismatched",
        "inactive",
        "missing",
        "overall_quality_score",
        *shares,
        joined("issues_summary").alias("issues_summary"),
    )


@query
def status_counts(spark, sf_dir):
    return _results(spark, sf_dir, "client_large").agg(*Q.status_counts())


@query
def overall_score(spark, sf_dir):
    return _results(spark, sf_dir, "client_large").agg(Q.overall_score().alias("overall_score"))


@query
def field_completeness(spark, sf_dir):
    fields = ("entity_lei", "gleif_name", "gleif_country")
    return _results(spark, sf_dir, "client_large").agg(*[Q.filled_share(f).alias(f) for f in fields])


@query
def quality_alerts(spark, sf_dir):
    report = Q.batch_report(_results(spark, sf_dir, "client_large"))
    return report.select(F.explode("issues_summary").alias("alert"))


@query
def quality_report(spark, sf_dir):
    report = Q.batch_report(_results(spark, sf_dir, "client_large"))
    return _flat_report(report, "lei", "gleif_name", "gleif_country")


def _curated(spark, sf_dir) -> DataFrame:
    return _results(spark, sf_dir).withColumn("processed_at", at(RUN_AT))


@query
def store_quality_report(spark, sf_dir):
    return _flat_report(Q.store_report(_curated(spark, sf_dir)), "lei", "name", "country")


@query
def store_completeness(spark, sf_dir):
    fields = ("entity_lei", "gleif_name", "gleif_country")
    return _curated(spark, sf_dir).agg(*[Q.non_null_share(f).alias(f) for f in fields])


@query
def run_metrics(spark, sf_dir):
    return Q.run_metrics(_results(spark, sf_dir, "client_large"))


@query
def quality_history(spark, sf_dir):
    report = Q.batch_report(_results(spark, sf_dir))
    rows = Q.history_row(report, "run-1", at(RUN_AT))
    return rows.withColumn("run_at", _time("run_at"))


@query
def top_entities(spark, sf_dir):
    rows = C.top_entities(_curated(spark, sf_dir))
    return rows.select("client_id", "verification_status", "quality_score")


@query
def upsert_merge(spark, sf_dir):
    update = validate(
        fixture(spark, sf_dir, "client_update"),
        fixture(spark, sf_dir, "registry"),
        keep=("position",),
    )
    store = C.CuratedStore(spark, run_folder(spark, "upsert"), buckets=8)
    store.upsert(_results(spark, sf_dir), "client_id", at(RUN_AT))
    store.upsert(update, "position", at(LATER))
    return _flat_results(store.read(), _time("processed_at"))


def _merged_three_times(spark, sf_dir) -> C.CuratedStore:
    """A store that takes all clients in three merges, which overlap and come out of order."""
    results = _results(spark, sf_dir)
    number = F.substring("client_id", 2, 20).cast("long")
    store = C.CuratedStore(spark, run_folder(spark, "merges"), buckets=8)
    store.upsert(results.where(number % 2 == 0), "client_id", at(LATER))
    store.upsert(results.where(number % 3 == 0).withColumn("quality_score", F.lit(0.1)), "client_id", at(RUN_AT))
    store.upsert(results.where(number % 2 == 1), "client_id", at(LATER))
    return store


@query
def merged_store_report(spark, sf_dir):
    """The store's report from the totals that merges leave behind."""
    return _flat_report(_merged_three_times(spark, sf_dir).report(), "lei", "name", "country")


@query
def merged_status_mart(spark, sf_dir):
    return _merged_three_times(spark, sf_dir).mart()


@query
def issues_json(spark, sf_dir):
    return _results(spark, sf_dir).select("client_id", C.issues_json(F.col("issues")).alias("issues"))


# --- resolution --------------------------------------------------------------------------------


@query
def token_sort_ratio_(spark, sf_dir):
    """Similarity of each client's name to the name registered under its identifier."""
    matched = match_registry(
        fixture(spark, sf_dir, "client_large"), fixture(spark, sf_dir, "registry")
    )
    score = token_sort_ratio(F.col("entity_name"), F.col("record.name"))
    return matched.select("client_id", score.alias("score"))


@query
def fuzzy_best_match(spark, sf_dir):
    names = fixture(spark, sf_dir, "names_client")
    offered = fixture(spark, sf_dir, "names_registry")
    keyed = names.select("id", token_sort_key(F.col("name")).alias("key"))
    best = best_names(
        keyed.select("key"), offered.select("id", token_sort_key(F.col("name")).alias("key"))
    )
    return keyed.join(best.withColumnRenamed("id", "match_id"), "key", "left").select(
        "id", "match_id", "score"
    )


def _vectors(spark, sf_dir, id_prefix: str | None = None) -> DataFrame:
    number = F.col("vec_id")
    ident = number if id_prefix is None else F.concat(F.lit(id_prefix), number.cast("string"))
    return table(spark, sf_dir, "embeddings").select(ident.alias("id"), F.col("embedding").alias("vector"))


@query
def vector_topk(spark, sf_dir):
    """Every vector asks, and all are offered."""
    vectors = _vectors(spark, sf_dir)
    return top_vectors(vectors, vectors)


@query
def vector_normalize(spark, sf_dir):
    """Unit vectors, told by their length and their weighted sum of components."""
    unit_vector = unit(F.col("embedding"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", unit_vector.alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    weighted = F.aggregate(
        F.transform("v", lambda x, i: x * (i + 1)), F.lit(0.0), lambda total, x: total + x
    )
    return rows.select(
        "vec_id",
        F.size("v").alias("dimensions"),
        F.round(squares, 6).alias("squared_length"),
        F.round(weighted, 6).alias("weighted_sum"),
    )


@query
def name_vector_topk(spark, sf_dir):
    """Nearest registry names of every client by letter-group vectors."""
    clients = fixture(spark, sf_dir, "client").select(F.col("client_id").alias("id"), "entity_name")
    records = fixture(spark, sf_dir, "registry").select(F.col("lei").alias("id"), "name")
    return top_vectors(name_vectors(clients, "entity_name"), name_vectors(records, "name"))


@query
def weighted_name_topk(spark, sf_dir):
    """Nearest registry names by vectors whose weights are fitted on the registry, saved and read
    again before the clients come."""
    clients = fixture(spark, sf_dir, "client").select(F.col("client_id").alias("id"), "entity_name")
    records = fixture(spark, sf_dir, "registry").select(F.col("lei").alias("id"), "name")
    path = run_folder(spark, "name-model")
    fit_name_vectors(records, "name").write().save(path)
    model = PipelineModel.load(path)
    return top_vectors(
        weighted_name_vectors(model, clients, "entity_name"),
        weighted_name_vectors(model, records, "name"),
    )


def _candidates(spark, sf_dir) -> DataFrame:
    """Registry candidates of the clients that have an embedding."""
    lei = F.concat(
        F.when(F.col("vec_id") % 20 == 7, "OLD").otherwise("LEI"),
        F.lpad(F.col("vec_id").cast("string"), 17, "0"),
    )
    registered = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("vec_id"))
    items = table(spark, sf_dir, "embeddings").join(registered, "vec_id", "left_semi")
    return top_vectors(
        _vectors(spark, sf_dir, "C"), items.select(lei.alias("id"), F.col("embedding").alias("vector"))
    )


def _lists(spark, sf_dir) -> DataFrame:
    return R.candidate_lists(_candidates(spark, sf_dir), fixture(spark, sf_dir, "registry"))


@query
def rerank_requests(spark, sf_dir):
    return R.rerank_requests(_lists(spark, sf_dir), fixture(spark, sf_dir, "client"))


def _outcome(column: str) -> list[Column]:
    return [
        F.col(f"{column}.record.lei").alias("lei"),
        F.round(F.col(f"{column}.score"), 4).alias("match_score"),
        F.col(f"{column}.method").alias("match_method"),
    ]


@query
def rerank_apply(spark, sf_dir):
    told = R.by_vector(_lists(spark, sf_dir), fixture(spark, sf_dir, "rerank_answers"))
    return told.select("client_id", *_outcome("by_vector"))


def _flat_resolutions(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("client_entity.client_id").alias("client_id"),
        F.col("matched_legal_entity.lei").alias("lei"),
        F.col("matched_legal_entity.name").alias("name"),
        "match_score",
        "match_method",
        joined("issues").alias("issues"),
    )


@query
def resolution_fallback(spark, sf_dir):
    """Clients with candidates keep their vector outcome; the others have no candidates."""
    clients, registry = fixture(spark, sf_dir, "client"), fixture(spark, sf_dir, "registry")
    answers = fixture(spark, sf_dir, "rerank_answers")
    rows = R.resolve(clients, registry, _candidates(spark, sf_dir), answers, names=False)
    return _flat_resolutions(rows).drop("issues")


@query
def resolution_without_index(spark, sf_dir):
    """No vectors and no names to search: every client stays open."""
    clients, registry = fixture(spark, sf_dir, "client"), fixture(spark, sf_dir, "registry")
    return _flat_resolutions(R.resolve(clients, registry, names=False))


@query
def listed_by_status(spark, sf_dir):
    """The listing of one status, cut where it has more rows."""
    rows = C.top_entities(_curated(spark, sf_dir), 100, "MISMATCH")
    return rows.select("client_id", "verification_status", "quality_score")


@query
def staged_newest(spark, sf_dir):
    """A limit that cuts within a run's rows."""
    rows = latest_staged(fixture(spark, sf_dir, "staged"), 500)
    return rows.select("client_id", "entity_name", "entity_lei", _time("ingested_at"))


def _unmatched_and_registry(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return materialize(unmatched_clients_(spark, sf_dir)), fixture(spark, sf_dir, "registry")


@query
def resolution_issues(spark, sf_dir):
    clients = fixture(spark, sf_dir, "client")
    seen = clients.join(R.by_vector(_lists(spark, sf_dir)), "client_id", "left")
    rows = R.finish(seen, "by_vector", otherwise=R.NO_CANDIDATES)
    return _flat_resolutions(rows).select("client_id", "match_score", "issues")


@query
def resolve_by_name(spark, sf_dir):
    return _flat_resolutions(R.resolve(*_unmatched_and_registry(spark, sf_dir)))


@query
def resolve_by_close_name(spark, sf_dir):
    """Only names of similarity 0.73 or more are matches: some of the shortened ones."""
    return _flat_resolutions(R.resolve(*_unmatched_and_registry(spark, sf_dir), min_score=0.73))


@query
def resolve_entities(spark, sf_dir):
    """All ways at once: answers, candidates, and names for the clients without a vector."""
    clients, registry = _unmatched_and_registry(spark, sf_dir)
    answers = fixture(spark, sf_dir, "rerank_answers")
    return _flat_resolutions(R.resolve(clients, registry, _candidates(spark, sf_dir), answers))


@query
def resolution_rate(spark, sf_dir):
    rows = R.resolve(*_unmatched_and_registry(spark, sf_dir))
    return Q.resolution_rate(rows).withColumn("rate", F.round("rate", 6))


@query
def entity_context(spark, sf_dir):
    return R.entity_context(fixture(spark, sf_dir, "registry"))


# --- views for downstream use --------------------------------------------------------------------


@query
def newly_inactive(spark, sf_dir):
    versions = fixture(spark, sf_dir, "registry_versions")
    before, after = (versions.where(F.col("ordinal") == n) for n in (1, 2))
    return V.newly_inactive(before, after)


@query
def ultimate_parents(spark, sf_dir):
    return V.ultimate_parents(fixture(spark, sf_dir, "parents"))


@query
def status_mart(spark, sf_dir):
    return V.status_mart(_curated(spark, sf_dir))


# --- whole jobs --------------------------------------------------------------------------------


def _write_upload(rows: DataFrame, path: str) -> str:
    """An upload folder with a header as people write them."""
    titles = {"client_id": " Client ID", "entity_name": "Entity Name ", "entity_lei": "ENTITY LEI"}
    titled = rows.select([F.col(name).alias(titles.get(name, name)) for name in rows.columns])
    titled.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


@query
def upload_run(spark, sf_dir):
    """One upload file folder through ingest, lookup, validation, store and report."""
    root = run_folder(spark, "upload-run")
    upload = _write_upload(fixture(spark, sf_dir, "upload_raw"), f"{root}/upload")
    store = C.CuratedStore(spark, f"{root}/curated", buckets=8)
    registry = G.current_records(fixture(spark, sf_dir, "registry_versions"))
    run = run_upload(
        spark, upload, registry, store, f"{root}/staged", run_id="run-1", run_at=at(RUN_AT)
    )
    return _flat_report(run.report, "lei", "gleif_name", "gleif_country")


@query
def daily_run(spark, sf_dir):
    """Two daily runs into one store; the second corrects the first.  Gives the export."""
    root = run_folder(spark, "daily-run")
    registry = fixture(spark, sf_dir, "registry")
    store = C.CuratedStore(spark, f"{root}/curated", buckets=8)
    first = _write_upload(fixture(spark, sf_dir, "upload_raw"), f"{root}/upload-1")
    run_upload(spark, first, registry, store, f"{root}/staged", run_id="run-1", run_at=at(RUN_AT))
    update = fixture(spark, sf_dir, "client_update")
    update = update.repartitionByRange(4, "position").sortWithinPartitions("position")
    second = _write_upload(update.drop("position"), f"{root}/upload-2")
    run = run_daily(
        spark,
        second,
        registry,
        store,
        f"{root}/staged",
        f"{root}/export",
        run_id="run-2",
        run_at=at(LATER),
    )
    exported = spark.read.parquet(run.export_path)
    return exported.select(*S.RESULT_COLUMNS, _time("processed_at"))


def _bad_line(number: Column) -> Column:
    """What makes every seventh line bad: a field too many; and every eleventh: no client id."""
    return F.when(number % 7 == 0, "seventh").when(number % 11 == 0, "eleventh")


@query
def upload_rejects(spark, sf_dir):
    """What an upload folder cannot take: surplus fields and rows without a client id."""
    root = run_folder(spark, "upload-rejects")
    rows = fixture(spark, sf_dir, "client").select("client_id", "entity_name", "entity_lei")
    number = F.substring("client_id", 2, 20).cast("long")
    bad = _bad_line(number)
    ident = F.when(bad == "eleventh", "").otherwise(F.col("client_id"))
    surplus = F.when(bad == "seventh", ",surplus").otherwise("")
    quoted = F.concat(F.lit('"'), F.coalesce("entity_name", F.lit("")), F.lit('"'))
    line = F.concat(ident, F.lit(","), quoted, F.lit(","), F.coalesce("entity_lei", F.lit("")), surplus)
    # One raw column, so that the lines are written as they are.
    lines = rows.select(line.alias("client_id,entity_name,entity_lei")).repartition(3)
    upload = f"{root}/upload"
    lines.write.options(header=True, quote="", sep="\x01").csv(upload)
    clients = to_clients(read_upload(spark, upload), "malformed")
    return rejected(clients).select("client_id", "entity_name", "malformed")


@query
def stream_run(spark, sf_dir):
    """The later batch as a file stream, each event twice, into an empty store."""
    root = run_folder(spark, "stream-run")
    events = fixture(spark, sf_dir, "client_update")
    time = F.timestamp_seconds(F.col("position")).alias("event_time")
    arrivals = events.select(*S.CLIENT_COLUMNS, time)
    arrivals.unionByName(arrivals).write.parquet(f"{root}/arrivals")
    stream = spark.readStream.schema(arrivals.schema).parquet(f"{root}/arrivals")
    store = C.CuratedStore(spark, f"{root}/curated", buckets=8)
    registry = fixture(spark, sf_dir, "registry")
    running = verify_stream(
        stream, registry, store, f"{root}/checkpoint", trigger={"availableNow": True}
    )
    running.awaitTermination()
    return _flat_results(store.read())


@query
def stream_out_of_order(spark, sf_dir):
    """The later batch in three micro-batches that hold older and newer records of the same clients."""
    root = run_folder(spark, "stream-late")
    events = fixture(spark, sf_dir, "client_update")
    time = F.timestamp_seconds(F.col("position")).alias("event_time")
    arrivals = events.select(*S.CLIENT_COLUMNS, time)
    store = C.CuratedStore(spark, f"{root}/curated", buckets=8)
    registry = fixture(spark, sf_dir, "registry")
    for part in range(3):
        some = arrivals.where(F.pmod(F.xxhash64("event_time"), F.lit(3)) == part)
        some.write.mode("append").parquet(f"{root}/arrivals")
        stream = spark.readStream.schema(arrivals.schema).parquet(f"{root}/arrivals")
        running = verify_stream(
            stream, registry, store, f"{root}/checkpoint", trigger={"availableNow": True}
        )
        running.awaitTermination()
    return _flat_results(store.read())
