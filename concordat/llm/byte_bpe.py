"""Byte-level BPE over Arrow batches, with the ``tokenizers`` library.

Every byte has a printable character; the library merges those characters, and the same table read
backwards turns tokens into bytes again.  Texts are cut at single blanks between words, where the
splitting pattern always cuts too, and each distinct piece of a block of texts is encoded once.
Nothing is remembered from one block to the next, so memory is that of a block.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import json
import os
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from concordat.llm.common import for_own_tasks, text_or_empty

# Bytes of texts that make a block, unless one text alone has more, and pieces encoded in one string.
BYTES = 16 << 20
TOGETHER = 256


@lru_cache(1)
def byte_characters() -> list[str]:
    """The character of each byte: itself where printable, else one from 256 upwards."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(byte if byte in printable else next(rest)) for byte in range(256)]


def _merged(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens that ``token`` is made of when only lower ranks may merge."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


@lru_cache(4)
def spec_from_ranks(path: str, pattern: str) -> str:
    """A tokenizer of the library, as JSON, for a rank file and its splitting pattern."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    names = byte_characters()
    named = {token: "".join(names[byte] for byte in token) for token in ranks}
    order = sorted((token for token in ranks if len(token) > 1), key=ranks.get)
    merges = [tuple(named[part] for part in _merged(token, ranks)) for token in order]
    vocabulary = {named[token]: rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer.to_str()


@lru_cache(4)
def spec_from_file(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


class ByteBpe:
    """A tokenizer and the table that turns its tokens back into bytes."""

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        # A task has one core; the library's own threads would take those of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_str(spec)
        self._tokenizer.encode_special_tokens = True
        byte_of = {name: byte for byte, name in enumerate(byte_characters())}
        self._bytes = {
            number: bytes(byte_of[name] for name in token)
            for token, number in json.loads(spec)["model"]["vocab"].items()
            if all(name in byte_of for name in token)
        }
        self._sizes = np.zeros(max(self._bytes) + 1, np.int64)
        self._sizes[list(self._bytes)] = [len(token) for token in self._bytes.values()]
        numbers = range(max(self._bytes) + 1)
        #: Each token as a blank and its number, and as its bytes.
        self.numerals = pa.array([b" %d" % number for number in numbers], pa.large_binary())
        self.contents = pa.array([self._bytes.get(n, b"") for n in numbers], pa.large_binary())

    def ids(self, text: str) -> list[int]:
        return self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def ids_with_added(self, text: str) -> list[int]:
        """As the library has it by default: strings of added tokens become those tokens."""
        self._tokenizer.encode_special_tokens = False
        try:
            return self.ids(text)
        finally:
            self._tokenizer.encode_special_tokens = True

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """The byte at which each token ends."""
        return np.cumsum(self._sizes[ids])

    def token_bytes(self, ids: Iterable[int]) -> list[bytes]:
        return [self._bytes[number] for number in ids]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join([self._bytes[number] for number in ids])

    def starts(self, ids: Iterable[int]) -> list[int]:
        """The code point in which each token starts; a token may start inside a character."""
        found, done = [], 0
        for token in self.token_bytes(ids):
            inner = token[:1] and 0x80 <= token[0] < 0xC0
            found.append(done - 1 if inner else done)
            done += sum(byte & 0xC0 != 0x80 for byte in token)
        return found

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """The text that each token completes; a split character comes with its last token."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for token in self.token_bytes(ids):
            yield decoder.decode(token)


#: For each value of the tokens, where each token's bytes begin, the end, and all bytes.
Values = list[tuple[np.ndarray, np.ndarray]]


class Encoder:
    """Encodes an Arrow column of texts piece by piece.

    A blank between two other characters that are no white space always begins a new match of the
    splitting pattern, so texts are cut there and each distinct piece of a block is encoded once.
    Many pieces are encoded together, and the tokens' byte offsets tell which piece they belong to.
    ``made`` turns ids into bytes, one value or more for each, which are then gathered for the whole
    texts.  With ``added``, texts that hold the string of an added token are encoded whole, as the
    library does.
    """

    def __init__(
        self, spec: str, made: Callable[[ByteBpe, np.ndarray], Values], added: bool = False
    ) -> None:
        self._bpe, self._made = ByteBpe(spec), made
        tokens = json.loads(spec).get("added_tokens") or [] if added else []
        self._added = [token["content"] for token in tokens]

    def _together(self, pieces: pa.Array, before: str, after: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces that each stand between ``before`` and ``after``, one of them a blank or
        a line feed and the other empty, and where each piece's ids begin."""
        cuts = pa.array([*range(0, len(pieces), TOGETHER), len(pieces)], pa.int32())
        grouped = pa.ListArray.from_arrays(cuts, pieces)
        between = pa.scalar(before + after, pa.large_string())
        strings = pc.binary_join(grouped, between).to_pylist()
        found = [np.zeros(0, np.int64)]
        found += [np.array(self._bpe.ids(before + one + after), np.int64) for one in strings]
        ids = np.concatenate(found)
        past = np.cumsum(pc.binary_length(pieces).to_numpy(zero_copy_only=False) + 1)
        return ids, np.append(0, np.searchsorted(self._bpe.ends(ids), past, "right"))

    def _openings(self, begins: pa.Array, alone: np.ndarray, added: np.ndarray) -> list[np.ndarray]:
        """The ids of the texts' first pieces, and of whole texts."""
        none = np.zeros(0, np.int64)
        found = [none] * len(begins)
        safe = (~alone & ~_touching_white(begins)).nonzero()[0]
        if len(safe):
            # A single line feed between other characters is always a match of its own.
            ids, cuts = self._together(begins.take(pa.array(safe)), "", "\n")
            for at, a, b in zip(safe.tolist(), cuts.tolist(), cuts[1:].tolist()):
                found[at] = ids[a : b - 1]
        rest = np.ones(len(begins), bool)
        rest[safe] = False
        for at in np.flatnonzero(rest).tolist():
            text = begins[at].as_py()
            if text:
                encoded = self._bpe.ids_with_added if added[at] else self._bpe.ids
                found[at] = np.array(encoded(text), np.int64)
        return found

    def __call__(self, texts: pa.Array) -> Iterator[list[list[memoryview]]]:
        """For some texts after others, each of the values of every text."""
        texts = texts.cast(pa.large_string())
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(texts):
            done = sizes[first - 1] if first else 0
            past = max(first + 1, int(np.searchsorted(sizes, done + BYTES)))
            yield self._some(texts[first:past])
            first = past

    def _some(self, texts: pa.Array) -> list[list[memoryview]]:
        cut = pc.split_pattern(texts, " ")
        bounds = np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False)))
        heads = bounds[:-1]
        flat = cut.flatten()
        coded = flat.dictionary_encode()
        pieces, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        # Pieces that touch other white space tell nothing alone, and texts with one are encoded whole.
        white = _touching_white(pieces)
        odd = white[codes]
        firsts = flat.take(pa.array(heads))
        many = pa.array(np.diff(bounds) > 1)
        open_ended = pc.not_equal(pc.utf8_rtrim_whitespace(firsts), firsts)
        odd[heads] = pc.and_(open_ended, many).to_numpy(zero_copy_only=False)
        whole = np.add.reduceat(odd.astype(np.int64), heads) > 0
        special = np.zeros(len(texts), bool)
        for content in self._added:
            special |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        whole |= special
        safe = np.flatnonzero(~white)
        ids, cuts = self._together(pieces.take(pa.array(safe)), " ", "")
        begins = pc.if_else(pa.array(whole), texts, firsts)
        opening = self._openings(begins, whole, special)
        # Values are numbered: none, the safe pieces, and the texts' openings.  The first piece of a
        # text follows no blank, so each text's is a value of its own.
        place = np.zeros(len(pieces), np.int64)
        place[safe] = 1 + np.arange(len(safe))
        codes = place[codes]
        codes[np.repeat(whole, np.diff(bounds))] = 0
        codes[heads] = 1 + len(safe) + np.arange(len(heads))
        sizes = np.cumsum([len(one) for one in opening])
        starts = np.concatenate([[0], cuts, cuts[-1] + sizes])
        found = []
        for offsets, data in self._made(self._bpe, np.concatenate([ids, *opening])):
            at = pa.py_buffer(offsets[starts].astype(np.int64))
            values = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(starts) - 1, [None, at, pa.py_buffer(data)]
            )
            joined = values.take(pa.array(codes))
            _, at, data = joined.buffers()
            ends = np.frombuffer(at, np.int64)[joined.offset :][bounds].tolist()
            view = memoryview(data) if data else memoryview(b"")
            found.append([view[a:b] for a, b in zip(ends, ends[1:])])
        return found


def _touching_white(texts: pa.Array) -> np.ndarray:
    """Whether each text is empty, or begins or ends with white space."""
    trimmed = pc.binary_length(pc.utf8_trim_whitespace(texts))
    same = pc.equal(trimmed, pc.binary_length(texts))
    return ~pc.and_(same, pc.greater(trimmed, 0)).to_numpy(zero_copy_only=False)


@for_own_tasks
@lru_cache(2)
def encoder(
    spec: str, made: Callable[[ByteBpe, np.ndarray], Values], added: bool = False
) -> Encoder:
    """One for each worker until it gets other work, so that the tokenizer is built once."""
    return Encoder(spec, made, added)


def shared_spec(spark: SparkSession, spec: str):
    """The tokenizer's few megabytes, of fixed size, sent once to each executor."""
    return spark.sparkContext.broadcast(spec)


def little_endian(bpe: ByteBpe, ids: np.ndarray) -> Values:
    """The ids as 32-bit numbers."""
    return [(4 * np.arange(len(ids) + 1), ids.astype("<u4"))]


def encode(docs: DataFrame, spec: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``starts`` (the code point in which each token starts).

    A missing or empty text gives empty arrays; texts of any length are encoded whole.  Strings of
    special tokens are ordinary text.  Rows repeat as they are given and other columns are left out.
    """
    sent = shared_spec(docs.sparkSession, spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, bpe = encoder(sent.value, little_endian), ByteBpe(sent.value)
        for batch in batches:
            found = [raw for (some,) in encode_texts(batch.column(1)) for raw in some]
            ids = [list(raw.cast("I")) if len(raw) else [] for raw in found]
            starts = [bpe.starts(one) for one in ids]
            columns = [batch.column(0), pa.array(ids, INTS), pa.array(starts, INTS)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "starts"])

    texts = docs.select("doc_id", text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, ids array<int>, starts array<int>")


INTS = pa.list_(pa.int32())


def decode(tokens: DataFrame, spec: str) -> DataFrame:
    """``doc_id`` and ``data``, the bytes of the ``ids`` of each row; missing ids give no bytes."""
    sent = shared_spec(tokens.sparkSession, spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(sent.value)
        for batch in batches:
            data = [bpe.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"]
            )

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, data binary")


def _digested(bpe: ByteBpe, ids: np.ndarray) -> Values:
    """The ids as text and what they decode to; both are joined piece by piece."""
    found = []
    for tokens in (bpe.numerals, bpe.contents):
        taken = tokens.take(pa.array(ids))
        _, offsets, data = taken.buffers()
        found.append((np.frombuffer(offsets, np.int64)[: len(ids) + 1], data or b""))
    return found


def encode_digests(docs: DataFrame, spec: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every whole text.

    The ids and the bytes decoded from them are those of ``encode`` and ``decode``; they are digested
    where they arise, so that neither crosses between processes.
    """
    sent = shared_spec(docs.sparkSession, spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(sent.value, _digested)
        for batch in batches:
            counts, ids, data = [], [], []
            for numerals, bodies in encode_texts(batch.column(1)):
                for joined, body in zip(numerals, bodies):
                    counts.append(int((np.frombuffer(joined, np.uint8) == 0x20).sum()))
                    ids.append(hashlib.sha256(joined[1:]).hexdigest())
                    data.append(hashlib.sha256(body).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids), pa.array(data)]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    texts = docs.select("doc_id", text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
