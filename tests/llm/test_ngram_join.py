"""The n-gram join beside a comparison of all pairs."""

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from concordat.llm import ngram_join
from concordat.llm.common import table
from concordat.llm.components import components
from concordat.llm.ngram_join import Likeness, PrefixTree, join_alike


def shingles(text, size=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(docs, size=4, percent=85):
    sets = {doc_id: shingles(text, size) for doc_id, text in docs}
    holders = defaultdict(list)
    for doc_id, found in sets.items():
        for s in found:
            holders[s].append(doc_id)
    pairs, root = set(), {d: d for d in sets}
    for found in holders.values():
        pairs |= set(combinations(sorted(found), 2))

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {(d, len(sets[d]), find(d)) for d in sets}


def ours(df):
    return [(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_tables(spark, sf):
    docs = table(spark, f"/root/testdata/sf{sf}", "documents")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(ours(join_alike(docs, 4, 85))) == sorted(expected)


def made(seed):
    """Chains of edits, so that components hold texts that are not linked themselves."""
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(60)]
    texts = []
    for _ in range(25):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 5, 20, 60, 200]))
        common = rng.choice([[], ["a", "very", "common", "line", "of", "words"]])
        for _ in range(rng.randint(1, 14)):
            texts.append(rng.choice([" ", "\n", "\t "]).join(common + words))
            for _ in range(rng.randint(0, max(1, len(words) // 60))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words + rng.choices(vocabulary, k=max(1, len(words) // 12))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,heavy", [(1, 8), (2, 0.01), (3, 0.5)])
def test_chains(spark, monkeypatch, seed, heavy):
    monkeypatch.setattr(ngram_join, "HEAVY", heavy)
    docs = made(seed)
    found = ours(join_alike(spark.createDataFrame(docs, "doc_id long, text string"), 4, 85))
    assert sorted(found) == sorted(brute(docs))


@pytest.mark.parametrize("family", [4096, 5])
def test_a_family_of_near_copies(spark, monkeypatch, family):
    monkeypatch.setattr(ngram_join, "FAMILY", family)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(80)]
    docs = []
    for n in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(80)] = f"new{rng.randrange(40)}"
        docs.append((n, " ".join(words)))
    found = ours(join_alike(spark.createDataFrame(docs, "doc_id long, text string"), 4, 85))
    expected = brute(docs)
    assert sorted(found) == sorted(expected) and 1 < len({root for *_, root in expected}) < 120


def test_other_likeness(spark):
    docs = made(6)
    found = ours(join_alike(spark.createDataFrame(docs, "doc_id long, text string")))
    assert sorted(found) == sorted(brute(docs, 5, 80))


def test_odd_rows(spark):
    rows = [
        (5, None, 1), (4, "", 2), (3, " \n\t", 3), (9, "same words", 4), (8, "SAME\x0bwords", 5),
        (8, "SAME\x0bwords", 5), (None, "same words", 6), (7, "same  words x", 7), (2, "é É", 8), (1, "É é", 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class int")
    assert sorted(ours(join_alike(docs, 4, 85)), key=repr) == sorted(
        [(5, 0, 5), (4, 0, 4), (3, 0, 3), (9, 1, 8), (8, 1, 8), (8, 1, 8), (None, 1, None), (7, 1, 7), (2, 1, 2), (1, 1, 1)],
        key=repr,
    )
    assert join_alike(docs.limit(0)).collect() == []


def test_only_texts_that_are_compared_move(spark, no_auto_broadcast):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('some words ', 3) AS text")
    ids = spark.createDataFrame([(3,), (19_999,), (77_777,)], "doc_id long")
    found = {row.doc_id for row in ngram_join._marked(docs, ids).select("doc_id").collect()}
    assert {3, 19_999} <= found and len(found) < 300
    assert ngram_join._marked(docs, ids.limit(0)).count() == 0


def test_packed_sets():
    rng = np.random.default_rng(2)
    for size in (0, 1, 2, 500):
        one = rng.integers(0, 1 << 48, size).astype(np.uint64)
        for some in (one, np.sort(one)):
            assert (ngram_join.unpacked_set(ngram_join.packed_set(some)) == some).all()
        assert len(ngram_join.packed_set(one)) == 6 * size
    sizes = np.array([0, 1, 70_000, (1 << 31) - 1])
    assert (ngram_join.of_planes(ngram_join.planes(sizes, 4), 4) == sizes).all()


def test_tree():
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.choice(300, rng.integers(1, 250), replace=False)).astype(np.uint64) for _ in range(80)]
    sets += [np.delete(s, 0) for s in sets if len(s) > 1]
    tree = PrefixTree(Likeness(4, 85))
    for number, one in enumerate(sets):
        tree.insert(one, number)
    for other in sets:
        expected = set()
        for number, one in enumerate(sets):
            common = len(np.intersect1d(one, other))
            if 100 * common >= 85 * (len(one) + len(other) - common):
                expected.add((number, common))
        assert set(tree.overlaps(other)) == expected


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(400, 470)]
    links += [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120)] + [(7, 7)]
    root = {}

    def find(d):
        while root.setdefault(d, d) != d:
            d = root[d]
        return d

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {d: find(d) for d in root if find(d) != d}
