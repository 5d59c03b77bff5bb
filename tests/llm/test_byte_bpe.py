"""Byte-level BPE beside the tiktoken library."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken

from concordat.llm.byte_bpe import ByteBpe, byte_characters, decode, encode, encode_digests
from concordat.llm.common import table
from concordat.llm.queries import file_spec, rank_spec

TEXTS = [
    "",
    " ",
    "plain words, it's we'll DON'T 1234 5,6",
    " lead and  two   three    blanks \n\n \t tab\r\n end ",
    "naïve café — 東京 🎉🎊  x y   z \x1c\x1d \x85",
    "<|endoftext|> is text",
    "a\nb\n\nc \nd\n e",
    "x" * 5000 + " " + "é" * 3000,
]


@pytest.fixture(scope="module")
def plain():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def expected(plain, text):
    ids = plain.encode_ordinary(text)
    return (
        len(ids),
        hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(text.encode()).hexdigest(),
    )


def test_characters_are_distinct():
    assert len(set(byte_characters())) == 256 and byte_characters()[65] == "A"


def test_digests(spark, plain):
    rows = [(n, text, "clash", 0) for n, text in enumerate(TEXTS)] + [(99, None, "", 0), (99, None, "", 0), (None, "x", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string, n_tokens int")
    found = [tuple(row) for row in encode_digests(docs, rank_spec()).collect()]
    assert sorted(found, key=repr) == sorted(
        ((n, *expected(plain, text or "")) for n, text, *_ in rows), key=repr
    )
    assert encode_digests(docs.limit(0), rank_spec()).collect() == []


def test_whole_table(spark, plain):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    found = {row.doc_id: tuple(row)[1:] for row in encode_digests(docs, rank_spec()).collect()}
    assert found == {row.doc_id: expected(plain, row.text) for row in docs.collect()}


def test_both_files_agree(plain):
    for text in TEXTS:
        assert ByteBpe(rank_spec()).ids(text) == ByteBpe(file_spec()).ids(text) == plain.encode_ordinary(text)


def test_round_trip_and_starts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    tokens = encode(docs, rank_spec())
    data = {row.doc_id: bytes(row.data).decode() for row in decode(tokens, rank_spec()).collect()}
    assert data == dict(enumerate(TEXTS))
    bpe = ByteBpe(rank_spec())
    for row in tokens.collect():
        text, done = TEXTS[row.doc_id], b""
        assert "".join(bpe.stream(row.ids)) == text
        for token, start in zip(bpe.token_bytes(row.ids), row.starts):
            assert start == len((done + b"|").decode(errors="ignore")) - 1 or token[0] >= 0x80
            assert text[start].encode().startswith(token[:1]) or 0x80 <= token[0] < 0xC0
            done += token
