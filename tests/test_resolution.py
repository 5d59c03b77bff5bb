import pytest
from pyspark.sql import functions as F

from concordat.operators.resolution import (
    by_vector,
    candidate_lists,
    entity_context,
    read_answer,
    rerank_requests,
    resolve,
)
from tests.helpers import client, clients, registry

RECORDS = [
    ("L1", "Apple Inc.", "US", "Corporation", "ACTIVE", None),
    ("L2", "Google LLC", "US", None, "ACTIVE", None),
    ("L3", "Microsoft Corporation", None, "Corporation", "ACTIVE", None),
]


def test_close_name_is_found(spark):
    rows = clients(spark, client("C_res", "Apple Incorporated"))
    row = resolve(rows, registry(spark, *RECORDS)).first()
    assert row.client_entity.client_id == "C_res"
    assert (row.matched_legal_entity.lei, row.match_method) == ("L1", "fuzzy")
    assert row.match_score == 0.67
    assert row.issues == ["Low match confidence: 0.67"]


def test_unrelated_name_still_gives_a_row(spark):
    rows = clients(spark, client("C", "Completely Unrelated XYZ Corp 12345"))
    found = resolve(rows, registry(spark, RECORDS[0])).collect()
    assert len(found) == 1 and found[0].match_score >= 0.0


def test_every_row_is_resolved_and_ties_go_to_the_lowest_identifier(spark):
    records = registry(spark, ("L9", "same", *[None] * 4), ("L5", "SAME", *[None] * 4), *RECORDS)
    rows = clients(
        spark,
        client("A", "Same."),
        client("A", "Same."),
        client("B", "qqq"),
        client("C", None),
        client("D", "LLC google"),
    )
    found = {}
    for row in resolve(rows, records).collect():
        found.setdefault(row.client_entity.client_id, []).append(row)
    assert len(found["A"]) == 2
    assert all((r.matched_legal_entity.lei, r.match_score, r.issues) == ("L5", 1.0, []) for r in found["A"])
    for name in "BC":
        assert found[name][0].matched_legal_entity is None
        assert found[name][0].issues == ["Low match confidence: 0.00", "No match found"]
        assert found[name][0].match_method == "fuzzy"
    assert found["D"][0].matched_legal_entity.lei == "L2"


def test_empty_sides(spark):
    rows = clients(spark, client("A", "a"))
    row = resolve(rows, registry(spark)).first()
    assert (row.match_method, row.matched_legal_entity, row.match_score) == ("no_method", None, 0.0)
    assert resolve(rows.limit(0), registry(spark, *RECORDS)).count() == 0


ANSWERS = [
    # answer, usable, choice, confidence  (of three candidates)
    ('{"match": 2, "confidence": 0.9, "reason": "x"}', True, 2, 0.9),
    (' {"match": 1}\n', True, 1, 0.0),
    ('{"match": null, "confidence": 0.3}', True, 0, None),
    ('{"confidence": 0.3}', True, 0, None),
    ('{"match": 0, "confidence": 0.3}', True, 0, None),
    ('{"match": 4, "confidence": 0.3}', True, 0, None),
    ('{"match": -1, "confidence": 0.3}', True, 0, None),
    ('{"match": true, "confidence": 1}', True, 1, 1.0),
    ('{"match": false}', True, 0, None),
    ('{"match": "", "confidence": 1}', True, 0, None),
    ('{"match": 9.5, "confidence": 1}', True, 0, None),
    ('{"match": 3, "confidence": "0.75"}', True, 3, 0.75),
    ('{"match": 3, "confidence": 1e-1}', True, 3, 0.1),
    ('{"match": 2.0, "confidence": 1}', False, 0, None),
    ('{"match": "2", "confidence": 1}', False, 0, None),
    ('{"match": [1], "confidence": 1}', False, 0, None),
    ('{"match": {"a": 1}}', False, 0, None),
    ('{"match": 1, "confidence": null}', False, 0, None),
    ('{"match": null, "confidence": "high"}', False, 0, None),
    ('{"match": 1, "confidence": [1]}', False, 0, None),
    ("The second one.", False, 0, None),
    ("[1]", False, 0, None),
    ("3", False, 0, None),
    ("null", False, 0, None),
    ("", False, 0, None),
    (None, False, 0, None),
]


def test_reading_answers(spark):
    rows = spark.createDataFrame([(i, a[0]) for i, a in enumerate(ANSWERS)], "i int, answer string")
    three = F.array(F.lit(1), F.lit(1), F.lit(1))
    got = rows.select("i", read_answer(F.col("answer"), three).alias("r")).orderBy("i").collect()
    for (answer, usable, choice, confidence), row in zip(ANSWERS, got):
        assert row.r.usable is usable, answer
        if usable:
            assert row.r.choice == choice, answer
        if usable and choice:
            assert row.r.confidence == pytest.approx(confidence), answer


def candidates(spark, *rows):
    return spark.createDataFrame(list(rows), "query_id string, rank int, id string, score double")


FOUND = [
    ("A", 1, "L2", 0.9),
    ("A", 2, "L1", 0.7),
    ("A", 3, "L3", 0.6),
    ("B", 1, "L3", 0.55555),
    ("X", 1, "L1", 1.0),
]


def test_rerank_requests(spark):
    lists = candidate_lists(candidates(spark, *FOUND), registry(spark, *RECORDS))
    asked = clients(spark, client("A", "n", country="DE", form=""), client("B", None))
    requests = {row.client_id: row for row in rerank_requests(lists, asked).collect()}
    assert requests["A"].client_line == '"n" (country: DE, legal form: unknown)'
    assert requests["B"].client_line == '"None" (country: unknown, legal form: unknown)'
    assert requests["X"].client_line is None
    lines = {name: row.candidate_list for name, row in requests.items()}
    assert lines["A"] == (
        "1. Google LLC | US | None | L2\n"
        "2. Apple Inc. | US | Corporation | L1\n"
        "3. Microsoft Corporation | None | Corporation | L3"
    )


def test_all_ways_together(spark):
    rows = clients(
        spark, client("A", "n"), client("B", "n"), client("D", "apple inc"), client("A", "n")
    )
    records = registry(spark, *RECORDS)
    answers = spark.createDataFrame(
        [("A", '{"match": 2, "confidence": 0.95}'), ("B", "no idea"), ("D", '{"match": 1}')],
        "client_id string, answer string",
    )
    found = {}
    for row in resolve(rows, records, candidates(spark, *FOUND), answers).collect():
        lei = row.matched_legal_entity and row.matched_legal_entity.lei
        found.setdefault(row.client_entity.client_id, []).append(
            (lei, row.match_score, row.match_method, row.issues)
        )
    assert found == {
        "A": [("L1", 0.95, "rag_llm", [])] * 2,
        "B": [("L3", 0.5556, "embedding", ["Low match confidence: 0.56"])],
        "D": [("L1", 1.0, "fuzzy", [])],
    }


def test_candidates_without_a_record_are_left_out(spark):
    rows = [("A", 1, "GONE", 0.95), ("A", 2, "L1", 0.7), ("B", 1, "GONE", 0.9)]
    found = candidates(spark, *rows)
    lists = candidate_lists(found, registry(spark, *RECORDS))
    assert [(r.client_id, r.by_vector.record.lei, r.by_vector.score) for r in by_vector(lists).collect()] == [
        ("A", "L1", 0.7)
    ]
    both = clients(spark, client("A", "n"), client("B", "n"))
    got = {r.client_entity.client_id: r for r in resolve(both, registry(spark, *RECORDS), found, names=False).collect()}
    assert got["B"].match_method == "embedding_no_candidates" and got["B"].match_score == 0.0
    assert resolve(both, registry(spark, *RECORDS), names=False).first().match_method == "no_index"


def test_answer_of_none_is_no_match(spark):
    lists = candidate_lists(candidates(spark, *FOUND), registry(spark, *RECORDS))
    answers = spark.createDataFrame([("A", '{"match": null}')], "client_id string, answer string")
    rows = {row.client_id: row.by_vector for row in by_vector(lists, answers).collect()}
    assert (rows["A"].record, rows["A"].score, rows["A"].method) == (None, 0.0, "rag_llm")
    assert (rows["B"].record.lei, rows["B"].method) == ("L3", "embedding")


def test_context_chunks_hold_every_record(spark):
    records = registry(spark, *RECORDS)
    chunks = entity_context(records, 2).orderBy("chunk").collect()
    assert [row.n_lines for row in chunks] == [2, 1]
    assert "\n".join(row.context for row in chunks) == (
        "L1: Apple Inc., US, ACTIVE\nL2: Google LLC, US, ACTIVE\nL3: Microsoft Corporation, None, ACTIVE"
    )


def test_shuffled_resolution_agrees(spark, shuffled, no_auto_broadcast):
    rows = clients(spark, *[client(f"C{i}", f"apple {i % 7}") for i in range(60)])
    records = registry(spark, *[(f"L{i}", f"apple {i}", *[None] * 4) for i in range(5)])
    found = resolve(rows, records)
    assert found.count() == 60
    perfect = found.where("match_score = 1.0")
    assert perfect.count() == sum(i % 7 < 5 for i in range(60))
