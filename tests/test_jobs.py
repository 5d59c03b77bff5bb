import os

from concordat.operators.curated import CuratedStore
from concordat.plans.verification import run_daily, run_upload
from concordat.sources.staging import read_staged
from tests.helpers import ACTIVE, LAPSED, at, registry

HEADER = "client_id,entity_name,entity_lei,country,legal_form,contact_email\n"
DAY_1 = HEADER + f"""C1,Apple Inc.,{ACTIVE[0]},US,Corporation,
C2,Old Name,{LAPSED[0]},GB,Limited,
C3,Apple Incorporated,,,,
,Nobody,,,,
C1,Apple Inc.,{ACTIVE[0]},FR,Corporation,
"""
DAY_2 = HEADER + f"C3,Apple Inc.,{ACTIVE[0]},,,\nC4,Defunct Ltd Corp,,,,\n"


def test_two_days(spark, tmp_path):
    for day, text in ((1, DAY_1), (2, DAY_2)):
        (tmp_path / f"day{day}.csv").write_text(text)
    records = registry(spark, ACTIVE, LAPSED)
    store = CuratedStore(spark, str(tmp_path / "store"), buckets=2)
    staging = str(tmp_path / "staged")

    def first():
        return run_upload(
            spark, str(tmp_path / "day1.csv"), records, store, staging, run_id="1", run_at=at()
        )

    run = first()
    assert run.report.first().total_records == 4
    assert [row.entity_name for row in run.rejects.collect()] == ["Nobody"]
    curated = sorted(map(tuple, store.read().collect()))
    assert [(row[0], row[3], row[11]) for row in curated] == [
        ("C1", "MISMATCH", 0.8),  # the later row of the file wins
        ("C2", "INACTIVE", 0.4),
        ("C3", "MISSING", 0.0),
    ]
    first()  # running it again changes nothing
    assert sorted(map(tuple, store.read().collect())) == curated
    assert read_staged(spark, staging).count() == 5

    day = run_daily(
        spark,
        str(tmp_path / "day2.csv"),
        records,
        store,
        staging,
        str(tmp_path / "export"),
        run_id="2",
        run_at=at("2024-01-02 00:00:00"),
    )
    resolved = day.resolutions.collect()
    assert [(r.client_entity.client_id, r.matched_legal_entity.lei) for r in resolved] == [
        ("C4", LAPSED[0])
    ]
    assert store.read().count() == 4
    assert store.history().first().total_records == 2
    exported = {row.client_id: row for row in spark.read.parquet(day.export_path).collect()}
    assert exported["C3"].verification_status == "VERIFIED" and exported["C3"].issues == "[]"
    assert os.path.exists(day.export_path)
