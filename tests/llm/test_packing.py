"""Packing: all pieces whole, gapless, and few sequences."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from concordat.llm import packing
from concordat.llm.common import table
from concordat.llm.packing import Packing, crossed, evolved, pack, token_pieces
from concordat.llm.queries import file_spec


def check(docs, rows, capacity=1024):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    assert len(by_doc) == len(docs)
    for doc_id, text in docs:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by_doc[doc_id], key=lambda row: row.piece)
        assert [p.piece for p in pieces] == list(range(math.ceil(len(ids) / capacity)))
        done = 0
        for p in pieces:
            cut = np.asarray(ids[done : done + p.length], "<u4").tobytes()
            assert p.start == done and p.ids_crc32 == zlib.crc32(cut)
            done += p.length
        assert done == len(ids) and all(p.length == capacity for p in pieces[1:])
    for members in by_sequence.values():
        done = 0
        for p in sorted(members, key=lambda row: row.offset):
            assert p.offset == done
            done += p.length
        assert done <= capacity
    return len(by_sequence), math.ceil(sum(row.length for row in rows) / capacity)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = pack(docs, file_spec()).collect()
    used, least = check([(row.doc_id, row.text) for row in docs.collect()], rows)
    print(used, least)
    assert used <= least * 1.02 + 1


def test_odd_rows(spark):
    schema = "doc_id long, text string, length int, island string, pattern int"
    rows = [(1, None, 1, "", 1), (2, "", 2, "", 2), (3, "a " * 5000, 3, "x", 3), (4, "b", 4, "", 4)]
    docs = spark.createDataFrame(rows, schema)
    used, least = check([row[:2] for row in rows], pack(docs, file_spec()).collect())
    assert used == least
    assert pack(docs.limit(0), file_spec()).collect() == []
    twice = pack(docs.unionByName(docs), file_spec()).collect()
    assert sum(row.length for row in twice) == 2 * sum(row.length for row in pack(docs, file_spec()).collect())


def test_large_and_missing_ids(spark):
    first = 2**53 + 1
    rows = [(first + 2 * i, "word " * (i % 40)) for i in range(400)] + [(None, "nameless")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = pack(docs, file_spec(), capacity=128).collect()
    assert sum(row.doc_id is None for row in packed) == 1
    check(rows, packed, capacity=128)


def test_added_tokens(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, f"{mark}{mark} a", f"a\n{mark}", f"x {mark[:-1]} y", "a b", f"a {mark}b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {row.doc_id: row for row in token_pieces(docs, file_spec(), 1024, 2).collect()}
    for doc_id, text in enumerate(texts):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.asarray(ids, "<u4").tobytes())
        assert (found[doc_id].length, found[doc_id].ids_crc32) == (len(ids), crc)


def test_repeated_rows_spread_over_islands(spark, monkeypatch):
    monkeypatch.setattr(packing, "ISLAND", 32)
    rows = [(7, "the same row")] * 150 + [(None, "no id")] * 150 + [(None, f"no id {i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(4)
    packed = pack(docs, file_spec(), capacity=16).collect()
    assert len(packed) == len(rows)
    assert sorted(Counter(row.doc_id for row in packed).values()) == [150, 170]
    assert max(Counter(row.sequence_id >> 32 for row in packed).values()) <= 80


def test_crossing_keeps_every_piece():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1024, 500)
    one = Packing(lengths, 1024)
    one.best_fit(rng.permutation(500))
    given = np.full(500, -1)
    given[[1, 2]] = 0 if lengths[1] + lengths[2] <= 1024 else -1
    child = crossed(one, given, rng)
    fills = np.bincount(child.holder, lengths)
    assert (child.holder >= 0).all() and fills.max() <= 1024
    assert fills.astype(int).tolist() == child.fills


def test_never_worse_than_best_fit():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 600, 3000)
    plain = Packing(lengths, 1024)
    plain.best_fit(np.argsort(-lengths, kind="stable"))
    assert evolved(lengths, 1024, 1).max() + 1 <= len(plain.fills)
