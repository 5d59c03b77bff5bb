import json

import pytest
from pyspark.sql import functions as F

from concordat import schemas as S
from concordat.operators.ordinal import with_ordinal
from concordat.sources import registry as G
from concordat.sources import staging
from concordat.sources.staging import clear, latest_staged, read_staged, stage
from concordat.sources.upload import accepted, check_suffix, read_upload, rejected, to_clients
from tests.helpers import MATCHING, at, client, clients, plan, registry

UPLOAD = """ Client ID ,Entity Name,ENTITY_LEI,country,legal form,contact_email,Notes
C1,"Acme, Inc.",00012,NA,LLC,a@x,"said ""hi"", left"
C2,,529900T8BM49AURSDO55,US,,,
,Nobody,,,,,
C3,  Blank ,, ,AG,,
"""


def upload(tmp_path, text=UPLOAD, name="upload.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_upload_file(spark, tmp_path):
    raw = read_upload(spark, upload(tmp_path))
    assert raw.columns[:2] == ["client_id", "entity_name"] and "notes" in raw.columns
    assert raw.first().notes == 'said "hi", left'
    rows = to_clients(raw, "upload_order")
    assert rows.columns == [*S.CLIENT_COLUMNS, "upload_order"]
    got = [tuple(r)[:7] for r in rows.orderBy("upload_order").collect()]
    assert got == [
        ("C1", "Acme, Inc.", "00012", "NA", "LLC", "a@x", None),
        ("C2", None, "529900T8BM49AURSDO55", "US", None, None, None),
        (None, "Nobody", None, None, None, None, None),
        ("C3", "  Blank ", None, " ", "AG", None, None),
    ]
    assert accepted(rows).count() == 3 and rejected(rows).first().entity_name == "Nobody"


def test_upload_refusals(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_upload(spark, str(tmp_path / "none.csv"))
    for name in ("book.xlsx", "book.XLS", "notes.txt"):
        with pytest.raises(ValueError):
            check_suffix(name)
    check_suffix("data/UPLOAD.CSV")
    with pytest.raises(ValueError, match="lacks columns: client_id"):
        read_upload(spark, upload(tmp_path, "name,entity_name\na,b\n"))
    with pytest.raises(ValueError, match="repeated columns"):
        read_upload(spark, upload(tmp_path, "client_id,Client ID,entity_name\na,b,c\n"))


def test_upload_folder(spark, tmp_path):
    folder = tmp_path / "day"
    folder.mkdir()
    upload(folder, "Client ID,Entity Name\nC1,one\n", "a.csv")
    upload(folder, "client id,entity name\nC2,two\n", "b.CSV")
    assert {r.client_id for r in read_upload(spark, str(folder)).collect()} == {"C1", "C2"}
    upload(folder, "x", "notes.txt")
    with pytest.raises(ValueError, match="notes.txt"):
        read_upload(spark, str(folder))


def test_upload_folder_with_another_order_of_columns(spark, tmp_path):
    upload(tmp_path, "client_id,entity_name\nC1,one\n", "a.csv")
    upload(tmp_path, "entity_name,client_id\ntwo,C2\n", "b.csv")
    with pytest.raises(Exception, match="does not conform"):
        read_upload(spark, str(tmp_path)).collect()


def test_rows_with_too_many_fields(spark, tmp_path):
    lines = 'C1,"a, b",x\nC2,b\nC3,c,y,z\nC4,Four, Inc,GB\nC5,e,\n'
    rows = to_clients(read_upload(spark, upload(tmp_path, "client_id,entity_name,country\n" + lines)), "malformed")
    assert {r.client_id for r in accepted(rows).collect()} == {"C1", "C2", "C5"}
    assert {r.malformed for r in rejected(rows).collect()} == {"C3,c,y,z", "C4,Four, Inc,GB"}


def test_upload_order_follows_the_file(spark, tmp_path):
    lines = "".join(f"C{i},name {i}\n" for i in range(5000))
    path = upload(tmp_path, "client_id,entity_name\n" + lines)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        rows = read_upload(spark, path)
        assert rows.rdd.getNumPartitions() > 4
        got = [row.client_id for row in rows.orderBy("upload_order").collect()]
    finally:
        spark.conf.set(key, before)
    assert got == [f"C{i}" for i in range(5000)]


def test_line_breaks_in_quotes(spark, tmp_path):
    path = upload(tmp_path, 'client_id,entity_name\nC1,"two\nlines"\n')
    assert read_upload(spark, path, multiline=True).first().entity_name == "two\nlines"


def test_staging(spark, tmp_path):
    root = str(tmp_path / "staged")
    first = clients(spark, MATCHING, client("C2", "b"))
    stage(first, root, "r1", at("2024-01-01 00:00:00"))
    stage(clients(spark, client("C9", "z", phone="1")), root, "r2", at("2024-01-02 00:00:00"))
    stage(first, root, "r1", at("2024-01-01 00:00:00"))  # again: replaces its own rows
    staged = read_staged(spark, root)
    assert staged.count() == 3
    newest = latest_staged(staged, 2).collect()
    assert [row.client_id for row in newest] == ["C9", "C001"]
    assert newest[0].contact_phone == "1"
    clear(spark, root)
    assert read_staged(spark, root).count() == 0
    stage(first, root, "r3", at())
    assert read_staged(spark, root).count() == 2


PAGE = {
    "data": [
        {
            "id": "L1",
            "attributes": {
                "entity": {
                    "legalName": {"name": "Apple Inc."},
                    "legalAddress": {"country": "US"},
                    "legalForm": {"name": "Corporation"},
                },
                "registration": {"status": "ACTIVE"},
                "registrationAuthority": {"id": "RA1"},
            },
        },
        {"id": "L2", "attributes": {"entity": {"legalName": None}, "registration": {}}},
        {"id": "L3"},
        {"id": "L4", "attributes": None, "extra": 1},
    ]
}


def test_registry_pages(spark, tmp_path):
    (tmp_path / "lines.json").write_text(json.dumps(PAGE) + "\n" + '{"data": []}\n{}\n')
    (tmp_path / "page.json").write_text(json.dumps(PAGE, indent=2))
    expected = [
        ("L1", "Apple Inc.", "US", "Corporation", "ACTIVE", "RA1"),
        *[(f"L{i}", None, None, None, None, None) for i in (2, 3, 4)],
    ]
    for name, multiline in (("lines.json", False), ("page.json", True)):
        pages = G.read_pages(spark, str(tmp_path / name), multiline=multiline)
        assert [tuple(r) for r in G.flatten_pages(pages).orderBy("lei").collect()] == expected


def test_broken_pages_fail_the_read(spark, tmp_path):
    (tmp_path / "broken.json").write_text('{"data": [\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        G.read_pages(spark, str(tmp_path / "broken.json")).collect()


def test_last_version_wins(spark):
    rows = [
        (1, "L1", "old", None, None, "ACTIVE", None),
        (3, "L1", "new", None, None, None, None),
        (2, "L1", "mid", None, None, "LAPSED", "x"),
        (1, "L2", None, None, None, None, None),
    ]
    versions = spark.createDataFrame(
        rows, "ordinal int, lei string, name string, country string, legal_form string,"
        " status string, registration_authority string"
    )
    got = sorted(tuple(r) for r in G.current_records(versions).collect())
    assert got == [("L1", "new", *[None] * 4), ("L2", *[None] * 5)]


def test_lookups(spark):
    asked = clients(
        spark, client("a", "n", "L2"), client("b", "n", "L2"), client("c", "n", ""), client("d", "n", "L9")
    )
    requested = G.requested_identifiers(asked)
    assert sorted(r.lei for r in requested.collect()) == ["L2", "L9"]
    records = registry(spark, *[(f"L{i}", "n", None, None, None, None) for i in range(5)])
    assert [r.lei for r in G.lookup(records, requested).collect()] == ["L2"]
    assert G.lookup_one(records, "L3").first().lei == "L3"
    assert G.lookup_one(records, "L7").first() is None


def test_batches_are_full_and_in_order(spark):
    ids = spark.range(1050).select(F.format_string("L%05d", F.col("id") * 7 % 1050).alias("lei"))
    rows = G.lookup_batches(ids, 200).orderBy("lei").collect()
    assert [r.batch for r in rows] == [i // 200 for i in range(1050)]
    assert [r.ordinal for r in with_ordinal(ids, "lei").orderBy("lei").collect()] == list(range(1050))


def test_last_record_of_an_extract_wins(spark, tmp_path):
    def page(*rows):
        return json.dumps({"data": [{"id": i, "attributes": {"registration": {"status": t}}} for i, t in rows]})

    lines = [page(("L1", "a"), ("L2", "b"), ("L1", "c")), page(("L3", "d"), ("L2", "e"))]
    (tmp_path / "one.jsonl").write_text("\n".join(lines))
    (tmp_path / "two.jsonl").write_text(page(("L3", "f")))
    pages = G.read_pages(spark, str(tmp_path), ordered=True)
    records = G.current_records(G.flatten_pages(pages))
    assert {r.lei: r.status for r in records.collect()} == {"L1": "c", "L2": "e", "L3": "f"}


@pytest.mark.parametrize("spread", ["own", "few", "one", "hot"])
def test_newest_rows_whatever_the_times(spark, spread):
    n = 20_000
    time = {"own": "id", "few": "id % 7", "one": "5", "hot": "if(id % 3 = 0, 9000, id)"}[spread]
    rows = spark.range(n).select(
        *[F.concat(F.lit(name), F.lpad(F.col("id").cast("string"), 6, "0")).alias(name) for name in S.CLIENT_COLUMNS],
        F.expr(f"if(id % 50 = 49, null, timestamp_seconds({time}))").alias("ingested_at"),
    )
    expected = rows.orderBy(F.desc("ingested_at"), "client_id").limit(300).collect()
    newest = latest_staged(rows, 300)
    assert newest.collect() == expected
    assert "Window" not in plan(newest)
    if spread == "own":
        # What is left to sort is little more than what is asked for.
        cut = staging._cut(rows, 300)
        assert 300 <= rows.where(F.col("ingested_at") >= cut).count() <= 1000


def test_fewer_staged_rows_than_asked_for(spark):
    rows = spark.range(3).select(
        *[F.col("id").cast("string").alias(name) for name in S.CLIENT_COLUMNS],
        F.lit(None).cast("timestamp").alias("ingested_at"),
    )
    assert [r.client_id for r in latest_staged(rows, 10).collect()] == ["0", "1", "2"]
    assert latest_staged(rows.limit(0), 10).count() == 0
