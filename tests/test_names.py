import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from concordat.functions.lcs import Beginnings, best_ratios, lcs_pairs, ratio_pairs
from concordat.functions.text import normalized, token_sort_key, token_sort_ratio
from concordat.operators import name_search
from concordat.operators.name_search import best_names, candidate_pairs, measured

from tests.helpers import plan


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            above = row[j]
            row[j] = diagonal + 1 if x == y else max(above, row[j - 1])
            diagonal = above
    return row[-1]


def plain_ratio(a, b):
    if a == b:
        return 100
    if not a or not b:
        return 0
    total = len(a) + len(b)
    return round(100 * (1 - (total - 2 * table_lcs(a, b)) / total))


LETTERS = st.text(alphabet="ab cdé字", max_size=150)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(LETTERS, LETTERS), min_size=1, max_size=8))
def test_common_subsequence_equals_the_table(pairs):
    left, right = [p[0] for p in pairs], [p[1] for p in pairs]
    assert lcs_pairs(left, right).tolist() == [table_lcs(a, b) for a, b in pairs]
    assert ratio_pairs(left, right).tolist() == [plain_ratio(a, b) for a, b in pairs]
    assert ratio_pairs(left, right).tolist() == ratio_pairs(right, left).tolist()


def test_long_pairs_beside_short_ones():
    rng = random.Random(8)
    sizes = [(3, 5), (200, 300), (700, 20), (0, 400), (256, 255), (1200, 900)]
    pairs = [tuple("".join(rng.choices("abcd 字", k=n)) for n in size) for size in sizes]
    left, right = [p[0] for p in pairs], [p[1] for p in pairs]
    assert lcs_pairs(left, right).tolist() == [table_lcs(a, b) for a, b in pairs]


def test_one_very_long_pair_does_not_hold_up_a_chunk():
    rng = random.Random(9)
    short = ["".join(rng.choices("abcdefgh ", k=20)) for _ in range(4095)]
    long = "".join(rng.choices("abcdefgh ", k=5000))
    start = time.process_time()
    lcs_pairs([*short, long], [*short[::-1], long[::-1]])
    assert time.process_time() - start < 2


KEYS = [
    ("Apple Inc.", "apple inc"),
    ("Inc. Apple", "apple inc"),
    ("  APPLE,,inc ", "apple inc"),
    ("a_b c-d", "a_b c d"),
    ("Société Générale", "gnrale socit"),  # letters of the Latin-1 supplement are dropped
    ("Łódź 字2", "łdź 字2"),  # others stay
    ("!!", ""),
    (None, ""),
    ("10 2 1", "1 10 2"),
]

RATIOS = [
    ("Apple Incorporated", "Apple Inc.", 67),
    ("new york mets", "mets york NEW", 100),
    ("abc", "", 0),
    (None, None, 100),
    ("..", "", 100),
    ("ab", "cd", 0),
    ("a" * 100, "a" * 99, 99),
    ("a" * 101, "a" * 100, 100),  # rounds up
    ("abcdefgh", "hxxxxxxx", 12),  # 12.5 rounds to even
]


def test_keys_and_ratios(spark):
    keys = spark.createDataFrame([(k,) for k, _ in KEYS], "name string")
    got = keys.select(token_sort_key(F.col("name"))).collect()
    assert [row[0] for row in got] == [key for _, key in KEYS]
    pairs = spark.createDataFrame([(a, b) for a, b, _ in RATIOS], "a string, b string")
    got = pairs.select(token_sort_ratio(F.col("a"), F.col("b"))).collect()
    assert [row[0] for row in got] == [score for _, _, score in RATIOS]


def test_ratio_expression_equals_the_table(spark):
    rng = random.Random(12)
    sizes = [(0, 3), (59, 60), (60, 61), (61, 121), (180, 33), (300, 250), (7, 7), (20, 24)] * 4
    pairs = [tuple("".join(rng.choices("abc字é😀0", k=n)) for n in size) for size in sizes]
    pairs += [(a, a[1:] + "x") for a, _ in pairs if a]
    names = spark.createDataFrame(pairs, "a string, b string")
    keyed = names.select(token_sort_key(F.col("a")), token_sort_key(F.col("b"))).collect()
    ratio = names.select(token_sort_ratio(F.col("a"), F.col("b")))
    assert [row[0] for row in ratio.collect()] == [plain_ratio(a, b) for a, b in keyed]
    assert "EvalPython" not in plan(ratio)


def test_normalizing_cuts_all_white_space(spark):
    texts = ["\t A\x1f", " b c ", None, "", "É　"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [row[0] for row in rows.select(normalized(F.col("t"))).collect()]
    assert got == [(t or "").strip().lower() for t in texts]


def brute_force(queries, items):
    best = {}
    for q in queries:
        ranked = sorted((-plain_ratio(q, k), i) for k, i in items)
        if ranked and ranked[0][0] < 0:
            best[q] = (-ranked[0][0], ranked[0][1])
    return best


def found(spark, queries, items):
    asked = spark.createDataFrame([(q,) for q in queries] * 2, "key string")
    offered = spark.createDataFrame(items, "key string, id string")
    rows = best_names(asked, offered).collect()
    assert len(rows) == len({row.key for row in rows})
    return {row.key: (row.score, row.id) for row in rows}


@pytest.mark.parametrize("block_rows", [256, 16])
def test_best_names_equals_trying_every_pair(spark, monkeypatch, block_rows):
    monkeypatch.setattr(name_search, "BLOCK_ROWS", block_rows)
    random.seed(5)

    def name(longest):
        return "".join(random.choice("abcdef ") for _ in range(random.randint(0, longest)))

    queries = {name(12) for _ in range(150)} | {"x" * 210, "x" * 120, "", "zz"}
    items = [(name(12), f"L{i:03}") for i in range(200)]
    items += [("x" * 209, "L901"), ("x" * 211, "L900"), ("x" * 120, "L950"), ("x" * 120, "L940")]
    assert found(spark, queries, items) == brute_force(queries, items)


def skewed_names(seed, n):
    """Names of a few words, one of which a third of all names and most queries share."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeiorstn 0é字", k=rng.randint(2, 9))).strip() or "a" for _ in range(60)]

    def name():
        some = rng.sample(words, rng.randint(1, 3))
        return " ".join(sorted([*some, "holdings"] if rng.random() < 0.4 else some))

    def typo(text):
        at = rng.randrange(len(text) + 1)
        return text[:at] + rng.choice(["", "x", "q"]) + text[at + rng.randint(0, 2) :]

    items = [(name(), f"L{i:04}") for i in range(n)]
    queries = {typo(typo(key)) for key, _ in rng.sample(items, n // 3)} | {name() for _ in range(n // 5)}
    return queries | {"q", "holdings", "0123456789" * 12}, items


@pytest.mark.parametrize("pieces, block_rows", [((1, 2, 4, 8), 256), ((1, 2, 4, 8), 20), ((3,), 50)])
def test_skewed_words(spark, monkeypatch, pieces, block_rows):
    monkeypatch.setattr(name_search, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(name_search, "DIFFERENCES", pieces)
    queries, items = skewed_names(block_rows, 300)
    assert found(spark, queries, items) == brute_force(queries, items)


@pytest.mark.parametrize("least", [60, 90])
def test_least_score(spark, least):
    queries, items = skewed_names(7, 200)
    asked = spark.createDataFrame([(q,) for q in queries], "key string")
    rows = best_names(asked, spark.createDataFrame(items, "key string, id string"), least).collect()
    expected = {q: best for q, best in brute_force(queries, items).items() if best[0] >= least}
    assert {row.key: (row.score, row.id) for row in rows} == expected


def test_few_pairs_are_compared(spark):
    """Numbered names that share all other words, as registries have them."""
    items = [(f"{i:09} customer plc {('retail', 'trade', 'energy')[i % 3]}", f"L{i:05}") for i in range(2000)]
    asked = [(f"{i:09} customer plc {('retail', 'trade', 'energy')[i % 3]}",) for i in range(2000, 2300)]
    asked += [(f"{i:09} customer plc retial",) for i in range(0, 2000, 20)]
    queries = spark.createDataFrame(asked, "key string")
    offered = spark.createDataFrame(items, "key string, id string")
    pairs = candidate_pairs(measured(queries), measured(offered)).distinct().count()
    assert len(asked) <= pairs < 0.2 * len(asked) * len(items)


def test_no_names_to_search(spark):
    asked = spark.createDataFrame([("apple",)], "key string")
    none = spark.createDataFrame([], "key string, id long")
    assert best_names(asked, none).count() == 0
    assert best_names(asked.limit(0), none).count() == 0


@pytest.mark.parametrize("letters, longest", [("abcdef ", 12), ("ab 字é😀c", 40), ("abcde", 300)])
def test_best_of_a_block_equals_trying_every_pair(letters, longest):
    rng = random.Random(longest)
    names = ["".join(rng.choices(letters, k=rng.randint(1, longest))) for _ in range(150)]
    right, left = list(dict.fromkeys(names[:100])), names[90:]
    score, place = best_ratios(left, right)
    for i, name in enumerate(left):
        every = ratio_pairs([name] * len(right), right).tolist()
        assert score[i] == max(every)
        assert not score[i] or place[i] == every.index(score[i])


def test_names_like_none_are_never_paired_as_rows(spark, monkeypatch):
    """Renamed clients, which no word or piece brings near any name: blocks meet, not rows."""
    items = [(f"{i % 7} customer{i:06} plc", f"L{i:05}") for i in range(400)]
    queries = {f"{i}x renamed" for i in range(60)}
    monkeypatch.setattr(name_search, "_by_length", None)
    monkeypatch.setattr(name_search, "WHOLE_ROWS", 64)
    monkeypatch.setattr(name_search, "ASKED_ROWS", 16)
    assert found(spark, queries, items) == brute_force(queries, items)


@pytest.mark.parametrize("ending", [" plc", " trading company limited"])
def test_best_of_names_that_end_alike_and_have_a_floor(ending):
    rng = random.Random(len(ending))
    right = list(dict.fromkeys(f"{rng.randint(0, 9999):06} {rng.choice('ab')}x{ending}" for _ in range(300)))
    left = [f"{rng.randint(0, 9999)} renamed" for _ in range(80)] + right[:3] + ["plc", "?"]
    every = [ratio_pairs([name] * len(right), right).tolist() for name in left]
    for floor in (None, np.array([max(row) - i % 2 for i, row in enumerate(every)])):
        score, place = best_ratios(left, right, floor)
        assert score.tolist() == [max(row) for row in every]
        assert all(place[i] == row.index(max(row)) for i, row in enumerate(every) if max(row))


def test_beginnings_that_cannot_reach_the_floor_are_left_out():
    """Of 1,000 numbered names only few are followed to their end."""
    right = [f"{i:06} customer plc" for i in range(1000)]
    ends, rows, common = Beginnings([name[:6] for name in right]).met(["000321"], np.array([6]))
    assert 321 in ends.tolist() and len(ends) < 200


def test_names_that_lie_side_by_side_meet_in_one_block(spark, monkeypatch):
    items = [(f"{i:06} customer plc", f"L{i:05}") for i in range(400)]
    queries = {f"{i} renamed" for i in range(0, 400, 7)}
    monkeypatch.setattr(name_search, "WHOLE_ROWS", 64)
    monkeypatch.setattr(name_search, "ASKED_ROWS", 16)
    monkeypatch.setattr(name_search, "DRAWN_ROWS", 32)
    assert found(spark, queries, items) == brute_force(queries, items)
