"""Repeated byte strings beside a table of all of them."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from concordat.llm import suffix_dedup
from concordat.llm.bytescan import blocks
from concordat.llm.common import table
from concordat.llm.induced_sort import shares, suffix_order
from concordat.llm.suffix_dedup import remove_repeats, segments


def sorted_well(text, depth, memory):
    data = np.append(text, 0)
    order = suffix_order(data, depth, memory)
    assert sorted(order.tolist()) == list(range(len(data)))
    raw = data.astype(np.uint16).byteswap().tobytes()
    keys = [raw[2 * i : 2 * (i + depth)] for i in order]
    assert keys == sorted(keys)
    same = shares(data, order, depth)
    whole = [len(data) - i >= depth for i in order]
    assert same.tolist() == [False] + [
        keys[i] == keys[i - 1] and whole[i] and whole[i - 1] for i in range(1, len(keys))
    ]


@pytest.mark.parametrize("memory", [1 << 20, 64])
def test_suffix_order(memory):
    rng = np.random.default_rng(0)
    for size in (1, 2, 3, 7, 40, 300, 2000):
        for kinds in (1, 2, 3, 30, 250):
            sorted_well(rng.integers(1, kinds + 1, size), 20, memory)
    passage = rng.integers(2, 5, 150)
    parts = [np.concatenate([rng.integers(2, 5, 30), passage[a:], [1]]) for a in (0, 0, 3, 20, 70)]
    sorted_well(np.concatenate(parts * 3), 100, memory)
    sorted_well(np.tile([5, 3, 4], 200), 100, memory)


def brute(docs):
    """Spans by a table of every string of 100 bytes."""
    first, found = {}, []
    for doc_id, text in sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in first:
                gone[i : i + 100] = True
            else:
                first[raw[i : i + 100]] = True
        body = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        spans = int((gone[1:] < gone[:-1]).sum())
        digest = hashlib.sha256(body).hexdigest()
        found.append((doc_id, len(raw), int(gone.sum()), spans, digest))
    return found


def ours(df, **options):
    rows = remove_repeats(df, **options).select("doc_id", "repeats.*").collect()
    return [tuple(row) for row in rows]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_tables(spark, sf):
    docs = table(spark, f"/root/testdata/sf{sf}", "documents")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(ours(docs)) == sorted(expected)


def made(seed):
    rng = random.Random(seed)
    letters = "ab ü" if seed % 2 else "abcdefgh ß\n"
    passages = ["".join(rng.choices(letters, k=rng.choice([60, 98, 99, 100, 101, 150, 400]))) for _ in range(12)]
    passages += ["ab" * 120, "x" * 300]
    texts = []
    for _ in range(160):
        parts = [rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choices(letters, k=rng.randint(0, 130))) for _ in range(rng.randint(0, 6))]
        text = "".join(parts)
        if text and rng.random() < 0.3:
            at = rng.randrange(len(text))
            text = text[:at] + "Q" + text[at + 1 :]
        texts.append(text)
    return list(enumerate(texts + rng.choices(texts, k=40)))


@pytest.mark.parametrize("seed,heavy,memory", [(1, 1 << 16, 1 << 26), (2, 4, 1 << 10), (3, 2, 1 << 26)])
def test_passages(spark, monkeypatch, seed, heavy, memory):
    monkeypatch.setattr(suffix_dedup, "HEAVY", heavy)
    monkeypatch.setattr(suffix_dedup, "SORTED", 1 << 21 if seed == 1 else 700)
    docs = made(seed)
    found = ours(spark.createDataFrame(docs, "doc_id long, text string"), memory=memory)
    assert sorted(found) == sorted(brute(docs))


def test_long_text_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_STRETCH", 500)
    rng = random.Random(9)
    passage = "".join(rng.choices("abc", k=700))
    text = "".join(rng.choices("abc", k=900)) + passage + "!" + passage
    column = pa.array([text, passage, "", "short"], pa.large_string())
    windows = 0
    for block in blocks(column):
        keys, rows, made_ = segments(block)
        windows += int(made_["windows"].sum())
    assert windows == len(text) - 99 + len(passage) - 99


def test_odd_rows(spark):
    long = "word and more words " * 9
    rows = [
        (3, long, 1, "x"), (2, None, 2, "y"), (1, "", 3, "z"), (4, long, None, None), (4, long, None, None),
        (None, long, 5, "n"), (5, "é" * 60, 6, "e"), (6, "é" * 60, 7, "f"), (7, "a" + "é" * 60, 8, "g"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tag int, row string")
    kept = remove_repeats(docs)
    assert kept.columns == [*docs.columns, "repeats"]
    found = sorted([(r.doc_id, *r.repeats) for r in kept.collect()], key=repr)
    expected = {row[0]: row for row in brute([row[:2] for row in rows])}
    assert found == sorted([expected[row[0]] for row in rows], key=repr)
    texts = {r.doc_id: (r.text, r.tag, r.row) for r in kept.collect()}
    assert texts[2] == (None, 2, "y") and texts[1] == ("", 3, "z") and texts[7] == ("a", 8, "g")
    assert remove_repeats(docs.limit(0)).collect() == []
    two = spark.createDataFrame([(1, "x" * 99), (1, "y" * 250), (1, "y" * 99)], "doc_id long, text string")
    assert sorted(r.repeats.n_removed for r in remove_repeats(two).collect()) == [0, 0, 249]
