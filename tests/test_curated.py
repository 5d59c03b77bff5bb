import glob
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat import schemas as S
from concordat.operators import skew
from concordat.operators.curated import CuratedStore, issues_json, top_entities
from concordat.operators.quality import batch_report, store_report
from concordat.operators.registry_views import status_mart
from concordat.session import materialize
from tests.helpers import at, plan


def batch(spark, *rows):
    filled = [
        (i, "L", "n", status, True, True, True, "ACTIVE", ["a", "b"], "n", "c", score, place)
        for i, place, score, status in rows
    ]
    schema = T.StructType([*S.RESULT.fields, T.StructField("place", T.IntegerType())])
    return spark.createDataFrame(filled, schema)


def contents(store):
    return {r.client_id: (r.quality_score, str(r.processed_at)) for r in store.read().collect()}


def test_upsert_is_idempotent_and_last_wins(spark, tmp_path):
    store = CuratedStore(spark, str(tmp_path / "s"), buckets=4)
    assert store.read().count() == 0
    first = batch(spark, ("A", 1, 0.2, "MISMATCH"), ("A", 2, 1.0, "VERIFIED"), ("B", 3, 0.1, "MISSING"))
    day1, day2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    store.upsert(first, "place", at(day1))
    once = contents(store)
    assert once == {"A": (1.0, day1), "B": (0.1, day1)}
    store.upsert(first, "place", at(day1))
    assert contents(store) == once
    store.upsert(batch(spark, ("B", 1, 0.6, "VERIFIED"), ("C", 2, 0.0, "MISSING")), "place", at(day2))
    assert contents(store) == {"A": (1.0, day1), "B": (0.6, day2), "C": (0.0, day2)}
    # A store opened anew sees the same table and keeps its bucket count.
    again = CuratedStore(spark, str(tmp_path / "s"), buckets=99)
    assert again.buckets == 4 and contents(again) == contents(store)
    assert again.read().schema.fieldNames() == list(S.CURATED_COLUMNS)


def files(root):
    return {path: os.path.getmtime(path) for path in glob.glob(f"{root}/data/bucket=*/*.parquet")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root = str(tmp_path / "s")
    store = CuratedStore(spark, root, buckets=16)
    store.upsert(batch(spark, *[(f"C{i}", i, 0.4, "MISMATCH") for i in range(200)]), "place", at())
    before = files(root)
    store.upsert(batch(spark, ("C7", 1, 1.0, "VERIFIED")), "place", at("2024-01-02 00:00:00"))
    after = files(root)
    assert len({os.path.dirname(path) for path in before}) == 16
    assert len({os.path.dirname(path) for path in set(before) ^ set(after)}) == 1
    assert store.read().count() == 200
    assert store.read().where("client_id = 'C7'").first().quality_score == 1.0


def test_failed_merge_is_never_seen(spark, tmp_path):
    store = CuratedStore(spark, str(tmp_path / "s"), buckets=2)
    store.upsert(batch(spark, ("A", 1, 0.2, "MISMATCH")), "place", at())
    before = contents(store)
    broken = CuratedStore(spark, store.root)
    whole = broken.merged

    def failing(rows):
        return whole(rows).where(F.when(F.col("client_id") == "Z", F.raise_error(F.lit("lost"))).isNull())

    broken.merged = failing
    with pytest.raises(Exception, match="lost"):
        broken.upsert(batch(spark, ("A", 1, 1.0, "VERIFIED"), ("Z", 2, 1.0, "VERIFIED")), "place", at())
    assert contents(CuratedStore(spark, store.root)) == before
    store.upsert(batch(spark, ("B", 1, 0.4, "MISMATCH")), "place", at())
    assert set(contents(store)) == {"A", "B"}


def test_stores_opened_apart_take_turns(spark, tmp_path):
    one, two = (CuratedStore(spark, str(tmp_path / "s"), buckets=2) for _ in range(2))
    one.upsert(batch(spark, ("A", 1, 0.2, "MISMATCH")), "place", at())
    two.upsert(batch(spark, ("B", 1, 0.4, "MISMATCH")), "place", at())
    one.upsert(batch(spark, ("C", 1, 0.6, "VERIFIED")), "place", at())
    assert set(contents(one)) == set(contents(two)) == {"A", "B", "C"}


def test_late_rows_do_not_replace_newer_ones(spark, tmp_path):
    store = CuratedStore(spark, str(tmp_path / "s"), buckets=2)
    for day, score in ((2, 0.2), (1, 0.9), (3, 0.6), (2, 0.4)):
        store.upsert(batch(spark, ("A", 1, score, "MISMATCH")), "place", at(f"2024-01-0{day} 00:00:00"))
    assert contents(store) == {"A": (0.6, "2024-01-03 00:00:00")}
    # At one time the greater tie wins, whichever merge brings it.
    for tie, score in ((7, 0.7), (9, 0.9), (8, 0.8)):
        rows = batch(spark, ("B", 1, score, "MISMATCH"))
        store.upsert(rows, "place", at(), tie=F.lit(tie))
    assert contents(store)["B"][0] == 0.9


@pytest.mark.parametrize("small", [True, False])
def test_merges_of_any_size_give_the_same(spark, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    store = CuratedStore(spark, str(tmp_path / "s"), buckets=3)
    expected = {}
    for day, first in ((2, 0), (1, 40), (3, 80)):
        names = [f"C{i}" for i in range(first, first + 60)]
        rows = batch(spark, *[(name, 1, day / 10, "MISMATCH") for name in names])
        store.upsert(rows, "place", at(f"2024-01-0{day} 00:00:00"))
        expected |= {n: day / 10 for n in names if expected.get(n, 0) <= day / 10}
    assert {name: score for name, (score, _) in contents(store).items()} == expected


def test_totals_give_the_report_of_the_rows(spark, tmp_path):
    store = CuratedStore(spark, str(tmp_path / "s"), buckets=3)
    assert store.report().collect() == store_report(store.read()).collect()
    for day, first in ((2, 0), (1, 40), (3, 80)):
        rows = [(f"C{i}", 1, i % 11 / 10, ("MISSING", "VERIFIED")[i % 2]) for i in range(first, first + 60)]
        new = batch(spark, *rows).withColumn("gleif_name", F.expr("if(place = 1 and quality_score > 0.5, null, '')"))
        store.upsert(new, "place", at(f"2024-01-0{day} 00:00:00"))
        assert store.report().collect() == store_report(store.read()).collect()
        assert sorted(store.mart().collect()) == sorted(status_mart(store.read()).collect())
    assert store.report().first().total_records == 140


def exchanged(df, folder, column):
    """Exchanges of the plan that carry ``column`` as scanned from ``folder``."""
    steps = re.split(r"\n\(\d+\) ", plan(df))
    scans = [step for step in steps if step.startswith("Scan parquet") and folder in step]
    marks = [re.search(rf"{column}#\d+", step)[0] for step in scans if f"{column}#" in step]
    assert marks
    return [s for s in steps if s.startswith("Exchange") and any(f"{m}," in s for m in marks)]


@pytest.mark.parametrize("small", [True, False])
def test_a_small_batch_moves_no_stored_rows(spark, tmp_path, no_auto_broadcast, monkeypatch, small):
    if not small:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    store = CuratedStore(spark, str(tmp_path / "s"), buckets=4)
    store.upsert(batch(spark, *[(f"C{i}", i, 0.4, "MISMATCH") for i in range(300)]), "place", at())
    rows = materialize(store._stored().where("client_id < 'C2'"))
    merged = store.merged(rows)
    assert merged.count() == 300
    assert bool(exchanged(merged, f"{store.root}/data", "gleif_name")) != small


def test_listing_history_export(spark, tmp_path):
    store = CuratedStore(spark, str(tmp_path / "s"), buckets=2)
    rows = batch(
        spark,
        ("B", 1, 1.0, "VERIFIED"),
        ("A", 2, 1.0, "VERIFIED"),
        ("C", 3, 0.8, "MISMATCH"),
        ("D", 4, 0.9, "MISMATCH"),
    )
    store.upsert(rows, "place", at())
    assert [r.client_id for r in top_entities(store.read(), 3).collect()] == ["A", "B", "D"]
    listed = top_entities(store.read(), status="MISMATCH").collect()
    assert [r.client_id for r in listed] == ["D", "C"]
    assert top_entities(store.read(), status="x' OR '1'='1").count() == 0
    store.append_history(batch_report(rows), "r1", at())
    store.append_history(batch_report(rows), "r2", at())
    assert sorted(r.run_id for r in store.history().collect()) == ["r1", "r2"]
    assert store.history().first().total_records == 4
    path = store.export(str(tmp_path / "export"))
    assert os.path.exists(f"{path}/_SUCCESS")
    assert spark.read.parquet(path).first().issues == '["a","b"]'
    store.upsert(batch(spark, ("E", 1, 0.1, "MISSING")), "place", at())
    assert spark.read.parquet(store.export(path)).count() == 5


def test_issue_json(spark):
    row = spark.sql("""select array('a"b', 'é') x, array() y""")
    got = row.select(issues_json(F.col("x")), issues_json(F.col("y"))).first()
    assert tuple(got) == ('["a\\"b","é"]', "[]")
