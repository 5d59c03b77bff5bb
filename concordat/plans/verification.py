"""The two end-to-end jobs: verifying an upload, and the daily run that also resolves and exports.

Each stage hands a written table to the next, so an executor lost late in a run costs a re-read
and not the run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from concordat.operators.curated import CuratedStore
from concordat.operators.quality import batch_report
from concordat.operators.resolution import resolve
from concordat.operators.skew import fits_broadcast
from concordat.operators.validation import unmatched_clients, validate
from concordat.session import materialize
from concordat.sources.registry import lookup, requested_identifiers
from concordat.sources.staging import stage
from concordat.sources.upload import accepted, read_upload, rejected, to_clients


@dataclass(frozen=True)
class UploadRun:
    """What an upload left behind."""

    clients: DataFrame
    rejects: DataFrame
    results: DataFrame
    report: DataFrame


@dataclass(frozen=True)
class DailyRun:
    upload: UploadRun
    resolutions: DataFrame
    export_path: str


def _needed_records(clients: DataFrame, registry: DataFrame) -> DataFrame:
    """The registry as it is where it can be broadcast, else only the records asked for."""
    if fits_broadcast(registry):
        return registry
    return materialize(lookup(registry, requested_identifiers(clients)))


def run_upload(
    spark: SparkSession,
    upload_path: str,
    registry: DataFrame,
    store: CuratedStore,
    staging_root: str,
    *,
    run_id: str,
    run_at: Column,
    **rules,
) -> UploadRun:
    """Ingest, look up, validate, store, report.

    ``registry`` has one row per identifier.  A failing read fails the run.
    """
    raw = read_upload(spark, upload_path)
    rows = materialize(to_clients(raw, "upload_order", "malformed"))
    stage(rows, staging_root, run_id, run_at)
    clients = accepted(rows)
    known = _needed_records(clients, registry)
    results = materialize(validate(clients, known, keep=("upload_order",), **rules))
    store.upsert(results, "upload_order", run_at)
    return UploadRun(clients, rejected(rows), results, batch_report(results))


def run_daily(
    spark: SparkSession,
    upload_path: str,
    registry: DataFrame,
    store: CuratedStore,
    staging_root: str,
    export_path: str,
    *,
    run_id: str,
    run_at: Column,
    candidates: DataFrame | None = None,
    answers: DataFrame | None = None,
    **rules,
) -> DailyRun:
    """An upload run, resolution of its unmatched clients against the whole registry, a line in
    the quality history and an export of the curated table."""
    upload = run_upload(
        spark, upload_path, registry, store, staging_root, run_id=run_id, run_at=run_at, **rules
    )
    open_clients = unmatched_clients(upload.clients, upload.results)
    resolutions = materialize(resolve(open_clients, registry, candidates, answers))
    store.append_history(upload.report, run_id, run_at)
    return DailyRun(upload, resolutions, store.export(export_path))
