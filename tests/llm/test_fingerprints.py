"""Fingerprints: equality, order, change by differences, and likeness."""

import hashlib

import numpy as np

from concordat.llm import fingerprints as fp
from concordat.llm.common import table


def test_order_and_change():
    texts = ["a b c\nd e\n\nf", "d e\na b c\nf\n", "a b c\nd e\nf", "", "\n", "a b c\nd e\n\nf"]
    exact, signed = fp.fingerprints(texts)
    shown = fp.written(exact, signed)
    assert shown[0] == shown[1] == shown[5]
    assert len(set(shown)) == 4
    first = exact[0], signed[0]
    moved = fp.changed(first, ["d e", ""], ["new line here", "f"])
    there = fp.fingerprints(["f\nf\nnew line here\na b c"])
    assert (moved[0] == there[0][0]).all() and (moved[1] == there[1][0]).all()


def test_likeness_follows_the_share_of_common_text():
    rng = np.random.default_rng(4)
    words = [f"w{n}" for n in range(5000)]
    whole = [words[i] for i in rng.integers(0, 5000, 3000)]
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        kept = int(3000 * share)
        other = whole[:kept] + [words[i] for i in rng.integers(0, 5000, 3000 - kept)]
        pair = [" ".join(whole), " ".join(other)]
        exact, signed = fp.fingerprints(pair)
        found = fp.likeness((exact[:1], signed[:1]), (exact[1:], signed[1:]))[0]
        assert abs(found - share) < 0.2
    exact, signed = fp.fingerprints(["", "", "x y"])
    pairs = fp.likeness((exact[:2], signed[:2]), (exact[1:], signed[1:]))
    assert pairs.tolist() == [1.0, 0.0]


def expected(docs):
    rows = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    found = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        change = text[: len(text) - half] + following[:half]
        own, other, near = (fp.fingerprints([t]) for t in (text, change, following))
        digest = hashlib.sha256(change.encode()).hexdigest()
        likeness = float(fp.likeness(own, other)[0]), float(fp.likeness(own, near)[0])
        found.append((doc_id, len(text), digest, *fp.written(*own), *fp.written(*other), *likeness))
    return found


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    found = [tuple(row) for row in fp.fingerprint_documents(docs).collect()]
    assert sorted(found) == sorted(expected([(r.doc_id, r.text) for r in docs.collect()]))


def test_odd_rows(spark):
    rows = [
        (7, "é e\nx y", 1), (3, None, 2), (3, "", 2), (-5, "a" * 3001, 3), (None, "lost words", 4),
        (9, "last one here", 5), (9, "last one here", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    found = [tuple(row) for row in fp.fingerprint_documents(docs).collect()]
    assert sorted(found, key=repr) == sorted(expected([row[:2] for row in rows]), key=repr)
    assert fp.fingerprint_documents(docs.limit(0)).collect() == []
    alone = fp.fingerprint_documents(docs.where("doc_id = 7")).first()
    assert (alone.near_next, alone.n_chars) == (1.0, 7)


def test_very_frequent_words_do_not_wrap():
    one, other = (fp.fingerprints(["ha " * n]) for n in (65_537, 30_000))
    assert fp.likeness(one, other)[0] > 0.999
