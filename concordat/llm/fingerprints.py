"""Document fingerprints that can be added and subtracted.

A paragraph is hashed to a wide vector and a text's fingerprint is the sum of its paragraphs'
vectors, so it does not depend on their order and changes by a difference when paragraphs come or
go.  The vector has two parts: numbers modulo 2**64 drawn from a cryptographic hash of the whole
paragraph, which settle equality, and numbers modulo 2**32 that count the paragraph's word pairs
with random signs, from which the likeness of two texts is estimated.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.bytescan import BLOCK, Texts, blocks, mixed, words
from concordat.llm.common import below, partitions, sampled_cuts, text_or_empty

WIDE = 32  # numbers modulo 2**64
LANES = 256  # numbers modulo 2**32
# Parts for each shuffle partition.
PARTS = 4


def _exact(texts: list[str]) -> np.ndarray:
    """For each text the sum of its paragraphs' hashes and, last, their number, modulo 2**64."""
    found = np.zeros((len(texts), WIDE + 1), np.uint64)
    for row, text in enumerate(texts):
        paragraphs = text.encode().split(b"\n")
        drawn = b"".join([hashlib.shake_256(p).digest(8 * WIDE) for p in paragraphs])
        found[row, :WIDE] = np.frombuffer(drawn, "<u8").reshape(-1, WIDE).sum(0, dtype=np.uint64)
        found[row, WIDE] = len(paragraphs)
    return found


def _signed(block: Texts) -> np.ndarray:
    """For each text its word pairs, within paragraphs, counted with random signs modulo 2**32."""
    found = words(block)
    breaks = np.cumsum(block.data == 0x0A)
    paragraph = breaks[found.starts] if len(found.starts) else breaks[:0]
    # Neighbours in one text and paragraph pair up; a paragraph of one word counts that word.
    joined = (paragraph[1:] == paragraph[:-1]) & (found.texts[1:] == found.texts[:-1])
    alone = ~(np.append(joined, False) | np.append(False, joined)[: len(paragraph)])
    head = np.flatnonzero(joined)
    pairs = found.hashes[head] * np.uint64(0x9E3779B97F4A7C15) + found.hashes[head + 1]
    keys = mixed(np.concatenate([pairs, found.hashes[alone[: len(paragraph)]]]))
    rows = np.concatenate([found.texts[head], found.texts[alone[: len(paragraph)]]])
    lanes = (keys >> np.uint64(33)).astype(np.int64) % LANES
    signs = (keys & np.uint64(1)).astype(float) * 2 - 1
    total = np.bincount(rows * LANES + lanes, signs, block.number * LANES)
    return total.astype(np.int64).astype(np.uint32).reshape(-1, LANES)


def fingerprints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Both parts of the fingerprints of ``texts``, as the rows of two arrays."""
    signed = [np.zeros((0, LANES), np.uint32)]
    signed += [_signed(block) for block in blocks(pa.array(texts, pa.large_string()))]
    return _exact(texts), np.concatenate(signed)


def written(exact: np.ndarray, signed: np.ndarray) -> list[str]:
    return [
        base64.b64encode(a.tobytes() + b.tobytes()).decode()
        for a, b in zip(exact.astype("<u8"), signed.astype("<u4"))
    ]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """From 0 to 1 for each pair of fingerprints: the cosine of the counts that they hold.

    Equal fingerprints give 1.  A text without words is unlike any other.
    """
    one, two = (part[1].astype(np.int32).astype(float) for part in (a, b))
    # The difference is taken before the numbers are read as signed, so that it wraps as they do.
    apart = np.square((a[1] - b[1]).astype(np.int32).astype(float)).sum(1)
    sizes = np.square(one).sum(1), np.square(two).sum(1)
    norms = np.sqrt(sizes[0] * sizes[1])
    cosine = (sizes[0] + sizes[1] - apart) / np.where(norms > 0, 2 * norms, 1)
    cosine = np.where(norms > 0, np.clip(cosine, 0, 1), 0.0)
    equal = (a[0] == b[0]).all(1) & (a[1] == b[1]).all(1)
    return np.where(equal, 1.0, cosine)


def changed(fingerprint, gone: list[str], come: list[str]):
    """``fingerprint`` of a text after paragraphs have gone and come, without reading the text."""
    exact, signed = fingerprint
    minus, plus = (fingerprints(paragraphs) for paragraphs in (gone, come))
    return (
        exact - minus[0].sum(0, dtype=np.uint64) + plus[0].sum(0, dtype=np.uint64),
        signed - minus[1].sum(0, dtype=np.uint32) + plus[1].sum(0, dtype=np.uint32),
    )


# --- with the next document --------------------------------------------------------------------


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _in_order(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` in parts by id, each part sorted and followed by the next's first row.

    The texts are shuffled once; of the parts only their first ids, one for each, are fetched.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    cuts = sampled_cuts(docs.select("doc_id").where("doc_id is not null"), PARTS * parts)
    place = F.coalesce(below(F.col("doc_id"), cuts, True, kind) + 1, F.lit(0))
    rows = docs.select("doc_id", text_or_empty().alias("text"), place.alias("part"))
    firsts = rows.groupBy("part").agg(F.min("doc_id").alias("first")).orderBy("part").collect()
    before = [(firsts[i].first, firsts[i].part, firsts[i - 1].part) for i in range(len(firsts))]
    # One row for each part.
    heads = spark.createDataFrame(before, f"first {kind}, part int, earlier int")
    heads = heads.withColumnRenamed("part", "own")
    met = rows.join(
        F.broadcast(heads), (rows.part == heads.own) & rows.doc_id.eqNullSafe(heads["first"]), "left"
    )
    here = F.struct(F.col("part"), F.lit(0).alias("ahead"))
    ahead = F.struct(F.col("earlier").alias("part"), F.lit(1).alias("ahead"))
    both = F.when(F.col("own").isNull(), F.array(here)).otherwise(F.array(here, ahead))
    placed = met.select("doc_id", "text", F.explode(both).alias("at"))
    return (
        placed.select("doc_id", "text", "at.part", "at.ahead")
        .repartition(parts, "part")
        .sortWithinPartitions("part", "ahead", "doc_id", "text")
    )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they and the next one are.

    ``docs`` has ``doc_id`` and ``text``; other columns are left out.  Documents stand in the order
    of their ids, a missing id first, equal ids by text; after the last comes the first, and a lone
    document follows itself.  A missing text counts as empty.  Paragraphs end at line feeds, empty
    ones count.  An empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def told(rows: list[tuple]) -> pa.RecordBatch:
        """What is known of all rows but the last, each followed by the next."""
        texts = [row[1] for row in rows]
        own = fingerprints(texts)
        changes = [edited(a, b) for a, b in zip(texts, texts[1:])]
        other = fingerprints(changes)
        held, following = (own[0][:-1], own[1][:-1]), (own[0][1:], own[1][1:])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([row[0] for row in rows[:-1]], ids),
                pa.array([len(text) for text in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(text.encode()).hexdigest() for text in changes]),
                pa.array(written(*held)),
                pa.array(written(*other)),
                pa.array(likeness(held, other)),
                pa.array(likeness(held, following)),
            ],
            names,
        )

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    names += ["near_edited", "near_next"]
    ids = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal ids
        waiting: list[tuple] = []
        size, part, over = 0, None, False
        for batch in batches:
            ids = batch.schema.field(0).type
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[2] != part:
                    if len(waiting) > 1:
                        yield told(waiting)
                    waiting, size, part, over = [], 0, row[2], False
                if over:  # more rows that share the next part's first id
                    continue
                over = bool(row[3])
                waiting.append(row)
                size += len(row[1])
                if size > BLOCK and len(waiting) > 1:
                    yield told(waiting)
                    waiting, size = waiting[-1:], 0
        if len(waiting) > 1:
            yield told(waiting)

    return _in_order(docs).mapInArrow(
        run,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
