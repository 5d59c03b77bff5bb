"""Physical plans: what is read, what is shuffled, and what must never appear."""

import re

import pytest

import __spark_entry__ as entry
from concordat.operators import curated as C
from concordat.operators.quality import batch_report, store_report
from concordat.operators.validation import match_registry, validate
from concordat.plans.fixtures import fixture
from concordat.sources import registry as G
from concordat.sources.staging import latest_staged, read_staged, stage
from tests.helpers import at, plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clients and registry as plain Parquet tables."""
    root = tmp_path_factory.mktemp("tables")
    found = {}
    for name in ("client_large", "registry"):
        fixture(spark, SF, name).write.parquet(str(root / name))
        found[name] = spark.read.parquet(str(root / name))
    return found


def read_schemas(df):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))


CHEAP = (
    "status_score_counts client_registry_join lei_not_found registry_lookup registry_last_wins "
    "quality_report store_quality_report top_entities upsert_merge run_metrics verify_lei_batch"
).split()


@pytest.mark.parametrize("name", CHEAP)
def test_no_product_and_no_global_window(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Window" not in text and "PythonUDF" not in text and "EvalPython" not in text


def test_small_registry_is_broadcast_and_clients_stay_put(tables):
    text = plan(validate(tables["client_large"], tables["registry"]))
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text


def test_large_registry_is_joined_by_key_and_salt(tables, shuffled, no_auto_broadcast):
    text = plan(match_registry(tables["client_large"], tables["registry"]))
    assert "SortMergeJoin" in text and "CartesianProduct" not in text
    assert len(re.findall(r"hashpartitioning\(__lei#\d+, __salt#\d+", text)) == 2


def test_only_needed_columns_are_read(tables):
    counts = validate(tables["client_large"], tables["registry"]).select("verification_status")
    clients, records = read_schemas(counts)
    assert "contact_email" not in clients and "contact_phone" not in clients
    assert "registration_authority" not in records


def test_point_lookup_reaches_the_scan(tables):
    text = plan(G.lookup_one(tables["registry"], "L1"))
    assert "PushedFilters: [IsNotNull(lei), EqualTo(lei,L1)]" in text


def test_reports_scan_the_curated_table_once(spark, tmp_path, tables):
    store = C.CuratedStore(spark, str(tmp_path / "store"), buckets=4)
    results = validate(tables["client_large"], tables["registry"], keep=("contact_email",))
    store.upsert(results, "contact_email", at())
    for report in (store_report(store.read()), batch_report(store.read())):
        assert len(read_schemas(report)) == 1
    listed = C.top_entities(store.read(), 10, "MISMATCH")
    assert "TakeOrderedAndProject" in plan(listed)
    assert "EqualTo(verification_status,MISMATCH)" in plan(listed)
    # A second merge replaces the files of the buckets it touches.
    before = set(store.read().inputFiles())
    store.upsert(results, "contact_email", at())
    assert before.isdisjoint(store.read().inputFiles())


def test_staged_read_is_cut_by_time_at_the_scan(spark, tmp_path, tables):
    root = str(tmp_path / "staged")
    stage(tables["client_large"], root, "r1", at())
    assert "GreaterThanOrEqual(ingested_at" in plan(latest_staged(read_staged(spark, root), 10))
