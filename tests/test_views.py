import pytest

from concordat.operators.curated import CuratedStore
from concordat.operators.registry_views import newly_inactive, status_mart, ultimate_parents, write_mart
from concordat.streaming.verification import verify_stream
from tests.helpers import ACTIVE, registry


def test_newly_inactive(spark):
    def version(*rows):
        return spark.createDataFrame(rows, "lei string, status string")

    before = version(("A", "ACTIVE"), ("B", "LAPSED"), ("C", None), ("D", "ACTIVE"))
    after = version(("A", "LAPSED"), ("B", "LAPSED"), ("C", "retired"), ("D", "active"), ("E", "LAPSED"))
    assert sorted(r.lei for r in newly_inactive(before, after).collect()) == ["A", "C", "E"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_ultimate_parents(spark, monkeypatch, broadcast):
    from concordat.operators import skew

    if not broadcast:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(skew, "MIN_HOT_ROWS", 5)
    chain = [("n0", None)] + [(f"n{i}", f"n{i - 1}") for i in range(1, 40)]
    star = [(f"s{i}", "hub") for i in range(60)]  # the hub has no row
    cycle = [("x", "y"), ("y", "z"), ("z", "x"), ("below", "x"), ("lower", "below"), ("self", "self")]
    links = spark.createDataFrame(chain + star + cycle, "entity string, parent string")
    roots = {row.entity: row.root for row in ultimate_parents(links).collect()}
    assert len(roots) == len(chain + star + cycle)
    assert {roots[e] for e, _ in chain} == {"n0"}
    assert {roots[e] for e, _ in star} == {"hub"}
    assert {roots[e] for e, _ in cycle} == {None}


def test_mart(spark, tmp_path):
    rows = spark.createDataFrame(
        [("US", "VERIFIED", 1.0), ("US", "VERIFIED", 0.6), (None, "MISSING", 0.0)],
        "gleif_country string, verification_status string, quality_score double",
    )
    write_mart(status_mart(rows), str(tmp_path / "mart"))
    back = spark.read.parquet(str(tmp_path / "mart"))
    got = {(r.gleif_country, r.verification_status, r.records, r.mean_score) for r in back.collect()}
    assert got == {("US", "VERIFIED", 2, 0.8), (None, "MISSING", 1, 0.0)}


def test_stream_resumes_and_drops_repeats(spark, tmp_path):
    arrivals, schema = tmp_path / "in", (
        "client_id string, entity_name string, entity_lei string, country string,"
        " legal_form string, event_time timestamp"
    )
    store = CuratedStore(spark, str(tmp_path / "store"), buckets=2)

    def send(*rows):
        text = [(i, n, ACTIVE[0], None, None, t) for i, n, t in rows]
        frame = spark.createDataFrame(text, schema.replace("timestamp", "string"))
        frame = frame.withColumn("event_time", frame.event_time.cast("timestamp"))
        frame.coalesce(1).write.mode("append").parquet(str(arrivals))
        stream = spark.readStream.schema(schema).parquet(str(arrivals))
        verify_stream(
            stream,
            registry(spark, ACTIVE),
            store,
            str(tmp_path / "checkpoint"),
            trigger={"availableNow": True},
        ).awaitTermination()
        return {r.client_id: r.verification_status for r in store.read().collect()}

    first = send(
        ("A", "Apple Inc.", "2024-01-01 00:00:00"),
        ("A", "Pear", "2024-01-01 00:00:05"),
        ("A", "Pear", "2024-01-01 00:00:05"),
        ("B", "Apple", "2024-01-01 00:00:01"),
    )
    assert first == {"A": "MISMATCH", "B": "VERIFIED"}
    assert send(("A", "Apple", "2024-01-01 00:01:00")) == {"A": "VERIFIED", "B": "VERIFIED"}
