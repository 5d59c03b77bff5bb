"""Repeated byte strings by suffix sorting in shards.

Every window of ``LENGTH`` bytes is assigned to an anchor, the piece of ``GRAM`` bytes in it with the
smallest hash, so equal windows have equal anchors.  The windows of one anchor stand side by side
and make up a segment of the text.  Segments whose anchor occurs once are done with; the others go
to the shard of their anchor, copies of a whole segment folded on the way.  There the suffixes of
all segments are sorted by external induction, and windows that share their beginning with the one
sorted before them are repeats of the first in document order.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.llm.bytescan import Texts, blocks, mixed
from concordat.llm.common import partitions, releasing, staged, text_or_empty
from concordat.llm.induced_sort import MEMORY, shares, suffix_order

LENGTH = 100
GRAM = 32
WINDOW = LENGTH - GRAM + 1  # pieces that compete in a window
# An anchor that occurs so often is parted by the bytes around it; see ``_narrowed``.
HEAVY = 1 << 16
# Windows of a heavy anchor that share a shard by their place.
CLASS = 4
# Parts for each shuffle partition.
PARTS = 2
# Bytes of segments sorted together, unless one anchor alone has more.
SORTED = 1 << 21
# Longest stretch worked on at once; places within it take 24 bits.
_STRETCH = 1 << 23
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_BYTE = mixed(np.arange(1000, 1256))
_POWERS = np.array([pow(_BASE, GRAM - 1 - i, 1 << 64) for i in range(GRAM)], np.uint64)
#: A segment: where it begins in its text, how many windows it has, and where its anchor is.
SEGMENT = np.dtype([("start", "<u4"), ("windows", "u1"), ("anchor", "u1")])
SPAN = np.dtype([("start", "<u4"), ("past", "<u4")])


def gram_keys(data: np.ndarray) -> np.ndarray:
    """The key of the piece at each byte, by doubling a polynomial hash."""
    keys, span, factor = _BYTE[data], 1, _BASE
    while span < GRAM:
        keys = keys[:-span] * np.uint64(factor) + keys[span:]
        factor, span = factor * factor % (1 << 64), span * 2
    return mixed(keys)


def _stretches(block: Texts) -> Iterator[tuple[int, Texts]]:
    """The block, or the overlapping stretches of its one very long text."""
    if len(block.data) <= _STRETCH:
        yield 0, block
        return
    if block.number > 1:
        for text in range(block.number):
            low, high = block.offsets[text], block.offsets[text + 1]
            alone = Texts(block.first + text, block.data[low:high], np.array([0, high - low]))
            yield from _stretches(alone)
        return
    for low in range(0, max(1, len(block.data) - LENGTH + 1), _STRETCH - LENGTH + 1):
        data = block.data[low : low + _STRETCH]
        yield low, Texts(block.first, data, np.array([0, len(data)]))


def segments(block: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors' keys, the texts that hold them, and the segments, in text order."""
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, SEGMENT))]
    for moved, part in _stretches(block):
        size = len(part.data)
        if size < LENGTH:
            continue
        keys = gram_keys(part.data)
        ranked = (keys & ~_PLACE) | np.arange(len(keys), dtype=np.uint64)
        span = 1
        while 2 * span <= WINDOW:
            ranked = np.minimum(ranked[:-span], ranked[span:])
            span *= 2
        rest = WINDOW - span
        ranked = np.minimum(ranked[: len(ranked) - rest], ranked[rest:])
        chosen = (ranked & _PLACE).astype(np.int64)
        ends = np.repeat(part.offsets[1:], np.diff(part.offsets))[: len(chosen)]
        valid = np.arange(len(chosen)) + LENGTH <= ends
        begins = valid.copy()
        begins[1:] &= ~valid[:-1] | (chosen[1:] != chosen[:-1])
        starts = np.flatnonzero(begins)
        closes = valid.copy()
        closes[:-1] &= ~valid[1:] | (chosen[1:] != chosen[:-1])
        stops = np.flatnonzero(closes)
        texts = np.searchsorted(part.offsets, starts, "right") - 1
        made = np.zeros(len(starts), SEGMENT)
        made["start"] = starts - part.offsets[texts] + moved
        made["windows"] = stops - starts + 1
        made["anchor"] = chosen[starts] - starts
        found.append((keys[chosen[starts]], texts + part.first, made))
    return tuple(np.concatenate(part) for part in zip(*found))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of rows that are equal in all columns begin, and the end."""
    if not len(columns[0]):
        return np.zeros(1, np.int64)
    new = np.zeros(len(columns[0]) - 1, bool)
    for column in columns:
        new |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(columns[0])]])


# --- which anchors repeat ------------------------------------------------------------------------


def _anchor_rows(docs: DataFrame, parts: int) -> DataFrame:
    """The segments of each batch, packed into one row for each part of the anchors.

    An anchor that occurs more than once in a batch is known to repeat: its first segment goes to
    the anchor's part with the count, the others anywhere, with weight 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [segments(block) for block in blocks(batch.column(2))]
            if not found:
                continue
            keys, rows, made = (np.concatenate(part) for part in zip(*found))
            doc, tag = (batch.column(i).to_numpy(zero_copy_only=False)[rows] for i in (0, 1))
            order = np.lexsort((made["start"], rows, keys))
            bounds = _runs(keys[order])
            weight = np.zeros(len(keys), np.uint32)
            weight[order[bounds[:-1]]] = np.diff(bounds)
            part = mixed(np.where(weight > 0, keys, doc.astype(np.uint64))) % np.uint64(parts)
            order = np.lexsort((made["start"], rows, part))
            cuts = _runs(part[order])
            chosen = [order[a:b] for a, b in zip(cuts, cuts[1:])]
            wide = keys.view(np.uint8).reshape(-1, 8)[:, :6]
            columns = {
                "part": pa.array([int(part[c[0]]) for c in chosen], pa.int32()),
                "keys": [wide[c].tobytes() for c in chosen],
                "weights": [weight[c].tobytes() for c in chosen],
                "docs": [doc[c].astype("<i8").tobytes() for c in chosen],
                "tags": [tag[c].astype("<i8").tobytes() for c in chosen],
                "made": [made[c].tobytes() for c in chosen],
            }
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(
        releasing(run), "part int, keys binary, weights binary, docs binary, tags binary, made binary"
    )


def _joined(batches: Iterator[pa.RecordBatch], *kinds) -> list[np.ndarray]:
    found: list[list[np.ndarray]] = [[] for _ in kinds]
    for batch in batches:
        for column, kind, into in zip(batch.columns, kinds, found):
            into += [np.frombuffer(data, kind) for data in column.to_pylist() if data]
    return [np.concatenate(part) if part else np.zeros(0, kind) for part, kind in zip(found, kinds)]


def _repeating(packed: DataFrame, parts: int) -> DataFrame:
    """The segments whose anchor occurs again, packed into one row for each part of the texts.

    Heavy anchors have rows of their own, with the anchor as ``heavy`` and its count as ``many``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide, weight, doc, tag, made = _joined(batches, "u1", "<u4", "<i8", "<i8", SEGMENT)
        keys = np.zeros((len(weight), 8), np.uint8)
        keys[:, :6] = wide.reshape(-1, 6)
        keys = keys.view(np.uint64).ravel()
        order = np.argsort(keys, kind="stable")
        bounds = _runs(keys[order])
        total = np.add.reduceat(weight[order].astype(np.int64), bounds[:-1]) if len(order) else weight
        live = weight != 1
        live[order] |= np.repeat(total > 1, np.diff(bounds))
        much = np.flatnonzero(total >= HEAVY)
        live = np.flatnonzero(live)
        live = live[np.lexsort((made["start"][live], tag[live], doc[live]))]
        cuts = _runs(doc[live], tag[live])
        heads = live[cuts[:-1]]
        bodies = [made[live[a:b]] for a, b in zip(cuts, cuts[1:])] if len(live) else []
        yield _by_text_part(doc[heads], tag[heads], bodies, parts)
        heavy = keys[order[bounds[much]]].view(np.int64)
        none = [pa.nulls(len(much), pa.int32())] + [pa.nulls(len(much), pa.binary())] * 4
        counted = [pa.array(heavy), pa.array(total[much].astype(np.int64))]
        yield pa.RecordBatch.from_arrays([*none, *counted], PACKED)

    return packed.select("keys", "weights", "docs", "tags", "made").mapInArrow(
        releasing(run),
        "part int, docs binary, tags binary, counts binary, made binary, heavy long, many long",
    )


PACKED = ["part", "docs", "tags", "counts", "made", "heavy", "many"]


def _text_part(doc: int, tag: int, parts: int) -> int:
    """The part of a text, as ``_part_column`` gives it too."""
    return zlib.crc32(b"%d" % (doc ^ tag)) % parts


def _part_column(parts: int) -> Column:
    """The part of a text; rows that share an id are dealt by their tag."""
    number = F.col("doc").bitwiseXOR(F.col("tag"))
    return F.pmod(F.crc32(number.cast("string").cast("binary")), F.lit(parts)).cast("int")


def _by_text_part(
    docs: np.ndarray, tags: np.ndarray, bodies: list[np.ndarray], parts: int
) -> pa.RecordBatch:
    """What is known of some texts, one row for each part of the texts."""
    part = [_text_part(doc, tag, parts) for doc, tag in zip(docs.tolist(), tags.tolist())]
    part = np.array(part, np.int64)
    order = np.argsort(part, kind="stable")
    bounds = _runs(part[order])
    found = []
    for a, b in zip(bounds, bounds[1:]):
        own = order[a:b]
        counts = np.array([len(bodies[i]) for i in own], "<u4")
        body = np.concatenate([bodies[i] for i in own])
        texts = (docs[own].astype("<i8"), tags[own].astype("<i8"), counts, body)
        found.append((int(part[own[0]]), *(column.tobytes() for column in texts), None, None))
    kinds = [pa.int32()] + [pa.binary()] * 4 + [pa.int64()] * 2
    values = zip(*found) if found else [[]] * 7
    arrays = [pa.array(column, kind) for column, kind in zip(values, kinds)]
    return pa.RecordBatch.from_arrays(arrays, PACKED)


def _unpacked(found: dict, packed: Iterable[bytes], kind) -> None:
    """Add the texts of a row of ``_by_text_part`` to ``found``, under their number and tag."""
    docs, tags, counts, made = packed
    pairs = zip(np.frombuffer(docs, "<i8").tolist(), np.frombuffer(tags, "<i8").tolist())
    cuts = np.cumsum(np.frombuffer(counts, "<u4"))[:-1]
    for pair, own in zip(pairs, np.split(np.frombuffer(made, kind), cuts)):
        found.setdefault(pair, []).append(own)


# --- segments to their shards --------------------------------------------------------------------

_SHARD = "part int, keys binary, docs binary, tags binary, made binary, data binary, spans binary"


def _narrowed(key: int, text: bytes, made) -> Iterator[tuple[int, int, int]]:
    """Shard key, start and number of windows of the pieces of a heavy anchor's segment.

    Windows in which the anchor stands at about the same place have all but a few bytes in common
    if they are equal, so those bytes part them further and equal windows still meet.
    """
    start, stop = int(made["start"]), int(made["start"]) + int(made["windows"])
    anchor = start + int(made["anchor"])
    while start < stop:
        kind = (anchor - start) // CLASS
        past = min(stop, anchor - kind * CLASS + 1)
        core = text[anchor - kind * CLASS : anchor - (kind + 1) * CLASS + 1 + LENGTH]
        digest = hashlib.blake2b(core, digest_size=8, salt=kind.to_bytes(2, "little")).digest()
        yield key ^ int.from_bytes(digest, "little"), start, past - start
        start = past


def _segment_rows(rows: DataFrame, parts: int, heavy) -> DataFrame:
    """The texts' repeating segments, packed by the part of their anchor.

    Each partition of ``rows`` has its packed segments before its texts, which are in order.  It
    holds the segments while it reads the texts: six bytes for each piece of text between two
    anchors.  Equal segments in a batch are folded: all but the first become spans at once.
    """

    def packed(found: list, spans: list) -> Iterator[pa.RecordBatch]:
        gone = np.array([s[2:] for s in spans], "<u4").reshape(-1, 2).tobytes()
        docs = np.array([s[0] for s in spans], "<i8").tobytes()
        tags = np.array([s[1] for s in spans], "<i8").tobytes()
        columns = {name: [] for name in ("part", "keys", "docs", "tags", "made", "data", "spans")}
        if spans:
            values = (hash(found[0][0]) % parts if found else 0, b"", docs, tags, b"", b"", gone)
            for name, value in zip(columns, values):
                columns[name].append(value)
        if found:
            keys = np.array([f[0] for f in found], np.uint64)
            part = (mixed(keys) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = _runs(part[order])
            for a, b in zip(cuts, cuts[1:]):
                chosen = [found[i] for i in order[a:b]]
                made = np.array([(f[3], f[4], 0) for f in chosen], SEGMENT)
                columns["part"].append(int(part[order[a]]))
                columns["keys"].append(keys[order[a:b]].tobytes())
                columns["docs"].append(np.array([f[1] for f in chosen], "<i8").tobytes())
                columns["tags"].append(np.array([f[2] for f in chosen], "<i8").tobytes())
                columns["made"].append(made.tobytes())
                columns["data"].append(b"".join([f[5] for f in chosen]))
                columns["spans"].append(b"")
        kinds = [pa.int32()] + [pa.binary()] * 6
        arrays = [pa.array(v, k) for v, k in zip(columns.values(), kinds)]
        yield pa.RecordBatch.from_arrays(arrays, list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], list[np.ndarray]] = {}
        much = heavy.value
        for batch in batches:
            # A segment is known by its bytes alone: they say where its anchor is.
            seen, found, spans = {}, [], []
            pending = []
            for doc, tag, text, *more in zip(*(column.to_pylist() for column in batch.columns)):
                if more[0] is not None:
                    _unpacked(known, more, SEGMENT)
                    continue
                # Rows that repeat both id and text are one document.
                waiting = known.pop((doc, tag), None)
                if waiting is None:
                    continue
                raw = text.encode()
                every = np.sort(np.concatenate(waiting), order="start")
                for one in every.tolist():
                    start, windows, anchor = one
                    body = raw[start : start + windows + LENGTH - 1]
                    first = seen.setdefault(body, (doc, tag, start))
                    if first == (doc, tag, start):
                        pending.append((doc, tag, one, body, raw if len(much) else None))
                    else:
                        spans.append((doc, tag, start, start + len(body)))
            if pending:
                grams = b"".join([p[3][p[2][2] : p[2][2] + GRAM] for p in pending])
                grams = _BYTE[np.frombuffer(grams, np.uint8)].reshape(-1, GRAM)
                keys = mixed((grams * _POWERS).sum(1, dtype=np.uint64)) & np.uint64((1 << 48) - 1)
                for key, (doc, tag, one, body, raw) in zip(keys.tolist(), pending):
                    if key in much:
                        named = dict(zip(SEGMENT.names, one))
                        for own, start, windows in _narrowed(key, raw, named):
                            piece = raw[start : start + windows + LENGTH - 1]
                            found.append((own, doc, tag, start, windows, piece))
                    else:
                        found.append((key, doc, tag, one[0], one[1], body))
            yield from packed(found, spans)

    columns = ("doc", "tag", "text", "docs", "tags", "counts", "made")
    return rows.select(*columns).mapInArrow(releasing(run), _SHARD)


def _later_windows(bodies: list[bytes], windows: np.ndarray, memory: int) -> np.ndarray:
    """Spans (segment, first and past-the-end byte) of windows that an earlier one equals.

    Segments come in document order, so of equal windows the one that stands first in the joined
    text is the first.
    """
    sizes = windows.astype(np.int64) + LENGTH
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    joined = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8).astype(np.int16) + 2
    joined[offsets[1:] - 1] = 1
    text = np.append(joined, 0).astype(np.int16)
    order = suffix_order(text, LENGTH, memory)
    group = np.cumsum(~shares(text, order, LENGTH))
    owner = np.repeat(np.arange(len(bodies)), sizes)
    inside = np.arange(len(joined)) - offsets[owner]
    is_window = np.append(inside < windows[owner], False)
    picked = is_window[order]
    places, group = order[picked], group[picked]
    first = np.full(int(group.max()) + 1, len(text))
    np.minimum.at(first, group, places)
    later = np.sort(places[first[group] < places])
    return np.column_stack([owner[later], inside[later], inside[later] + LENGTH])


def _sorted_together(rows: np.ndarray, keys: np.ndarray, windows: np.ndarray) -> Iterator[np.ndarray]:
    """The rows whose key occurs more than once, in batches that hold all rows of their keys."""
    _, group, many = np.unique(keys, return_inverse=True, return_counts=True)
    sizes = np.bincount(group, windows + LENGTH) * (many > 1)
    batch = ((np.cumsum(sizes) - sizes) // SORTED).astype(np.int64)
    batch[many == 1] = -1
    own = batch[group]
    for number in np.unique(own[own >= 0]).tolist():
        yield rows[own == number]


def _shard_spans(packed: DataFrame, memory: int, parts: int) -> DataFrame:
    """The spans to remove that each shard finds, packed into one row for each part of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, tags, made, bodies = [], [], [], [], []
        out = [(np.zeros(0, np.int64),) * 2 + (np.zeros((0, 2), np.int64),)]
        for batch in batches:
            for k, d, t, m, data, spans in zip(*(column.to_pylist() for column in batch.columns)):
                d, t = np.frombuffer(d, "<i8"), np.frombuffer(t, "<i8")
                if spans:
                    out.append((d, t, np.frombuffer(spans, "<u4").reshape(-1, 2).astype(np.int64)))
                    continue
                m = np.frombuffer(m, SEGMENT)
                keys.append(np.frombuffer(k, np.uint64))
                docs.append(d)
                tags.append(t)
                made.append(m)
                ends = np.cumsum(m["windows"].astype(np.int64) + LENGTH - 1).tolist()
                bodies += [data[a:b] for a, b in zip([0, *ends], ends)]
        if bodies:
            keys, docs, tags, made = map(np.concatenate, (keys, docs, tags, made))
            order = np.lexsort((made["start"], tags, docs))
            seen, firsts, later = {}, [], []
            for i, key in zip(order.tolist(), keys[order].tolist()):
                # Pieces of heavy anchors have the bytes of other segments, so the key belongs too.
                first = seen.setdefault((key, bodies[i]), i)
                if first == i:
                    firsts.append(i)
                elif (docs[first], tags[first], made["start"][first]) != (docs[i], tags[i], made["start"][i]):
                    later.append(i)
            later = np.array(later, np.int64)
            begins = made["start"][later].astype(np.int64)
            sizes = made["windows"][later].astype(np.int64) + LENGTH - 1
            out.append((docs[later], tags[later], np.column_stack([begins, begins + sizes])))
            firsts = np.array(firsts)
            for met in _sorted_together(firsts, keys[firsts], made["windows"][firsts]):
                found = _later_windows([bodies[i] for i in met.tolist()], made["windows"][met], memory)
                own = met[found[:, 0]]
                begins = made["start"][own].astype(np.int64)
                out.append((docs[own], tags[own], found[:, 1:] + begins[:, None]))
        docs, tags, spans = (np.concatenate(part) for part in zip(*out))
        order = np.lexsort((spans[:, 0], tags, docs))
        docs, tags, spans = docs[order], tags[order], spans[order]
        cuts = _runs(docs, tags)
        merged = [_merged(spans[a:b]).astype("<u4") for a, b in zip(cuts, cuts[1:])]
        heads = cuts[:-1] if len(docs) else cuts[:0]
        docs, tags = docs[heads], tags[heads]
        whole = _by_text_part(docs, tags, merged, parts)
        yield whole.select(PACKED[:5])

    columns = ("keys", "docs", "tags", "made", "data", "spans")
    return packed.select(*columns).mapInArrow(
        releasing(run), "part int, docs binary, tags binary, counts binary, made binary"
    )


def _merged(spans: np.ndarray) -> np.ndarray:
    """Sorted spans with those that touch or overlap made one."""
    if not len(spans):
        return spans
    reach = np.maximum.accumulate(spans[:, 1])
    opens = np.append(True, spans[1:, 0] > reach[:-1])
    ends = np.append(np.flatnonzero(opens)[1:] - 1, len(spans) - 1)
    return np.column_stack([spans[opens, 0], reach[ends]])


# --- the operator --------------------------------------------------------------------------------


def _placed(docs: DataFrame) -> DataFrame:
    """``doc``, the number that orders a row, ``tag``, ``text`` and all other columns as ``row``.

    ``tag`` tells rows apart that share an id; it is 0 where none do.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    repeated = docs.groupBy(doc.alias("doc")).count().where("count > 1").limit(1).count()
    tag = F.xxhash64(text_or_empty()) if repeated else F.lit(0).cast("long")
    others = F.struct(*[name for name in docs.columns if name != "text"])
    return docs.select(doc.alias("doc"), tag.alias("tag"), "text", others.alias("row"))


def repeated_spans(docs: DataFrame, parts: int, memory: int = MEMORY) -> DataFrame:
    """The spans to remove of placed texts, packed by the part of the texts' numbers."""
    spark, text_parts = docs.sparkSession, parts
    parts = partitions(spark)
    texts = docs.select("doc", "tag", text_or_empty().alias("text"))
    packed = _anchor_rows(texts, PARTS * parts).repartition(parts, "part")
    repeating = staged(_repeating(packed, parts), "repeating")
    found = repeating.where("part is not null").drop("heavy", "many")
    # Heavy anchors are at least one in a million of all segments that repeat.
    total = found.agg(F.sum(F.octet_length("made"))).first()[0] or 0
    least = max(HEAVY, total // SEGMENT.itemsize >> 20)
    counts = repeating.where(F.col("many") >= least).select("heavy")
    heavy = spark.sparkContext.broadcast({row.heavy % (1 << 64) for row in counts.collect()})
    rows = texts.select(_part_column(parts).alias("part"), "doc", "tag", "text")
    rows = rows.unionByName(found, allowMissingColumns=True)
    rows = rows.repartitionById(parts, "part").sortWithinPartitions(
        F.col("docs").isNull(), "doc", "tag"
    )
    shards = _segment_rows(rows, PARTS * parts, heavy).repartition(parts, "part")
    return staged(_shard_spans(shards, memory, text_parts), "spans")


def remove_repeats(docs: DataFrame, memory: int = MEMORY) -> DataFrame:
    """The rows of ``docs`` without their repeated bytes.

    Texts are bytes in UTF-8.  A byte goes if a string of ``LENGTH`` bytes covers it that also starts
    earlier, in a document with a smaller id (a missing id comes first) or further up in the same
    one; strings are judged on the input and never cross documents.  Rows that repeat both id and
    text are one document; rows that share only the id are ordered by a hash of their text.  A
    missing text counts as empty and stays missing.  An empty table gives an empty result.

    All columns come back, whatever their names, with ``text`` without the removed bytes (a character
    that loses a byte goes), and beside them a struct ``repeats`` of ``n_bytes``, ``n_removed``,
    ``n_spans`` and ``kept_sha256``, the digest of the bytes that stay.
    """
    placed = _placed(docs)
    tasks = partitions(docs.sparkSession)
    parts = 4 * tasks
    found = repeated_spans(placed, parts, memory)
    inner = placed.schema["row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, found = None, {}
        for batch in batches:
            taken, texts, told = [], [], []
            columns = (column.to_pylist() for column in batch.columns[:7])
            for at, (part, doc, tag, packed, counts, made, text) in enumerate(zip(*columns)):
                if part != here:
                    here, found = part, {}
                if packed is not None:
                    _unpacked(found, (packed, tag, counts, made), SPAN)
                    continue
                raw, spans = (text or "").encode(), np.zeros((0, 2), np.int64)
                waiting = found.get((doc, int.from_bytes(tag, "big", signed=True)))
                if waiting:
                    every = np.sort(np.concatenate(waiting), order=["start", "past"])
                    spans = _merged(every.view("<u4").reshape(-1, 2).astype(np.int64))
                kept, done = [], 0
                for start, past in spans.tolist():
                    kept.append(raw[done:start])
                    done = past
                body = b"".join([*kept, raw[done:]])
                gone, digest = len(raw) - len(body), hashlib.sha256(body).hexdigest()
                taken.append(at)
                texts.append(body.decode(errors="ignore") if gone else text)
                told.append((len(raw), gone, len(spans), digest))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = zip(*told) if told else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(7).take(pa.array(taken, pa.int64())),
                    pa.array(texts, pa.string()),
                    *[pa.array(values, kind) for values, kind in zip(columns, kinds)],
                ],
                ["row", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    schema = T.StructType([inner]).add("text", "string")
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    schema = schema.add("kept_sha256", "string")
    none = F.lit(None).cast("binary")
    texts = placed.select(
        _part_column(parts).alias("part"),
        "doc",
        F.unhex(F.lpad(F.hex("tag"), 16, "0")).alias("tags"),
        *[none.alias(name) for name in ("docs", "counts", "made")],
        "text",
        "row",
    )
    spans = found.withColumns(
        {
            "doc": F.lit(None).cast("long"),
            "text": F.lit(None).cast("string"),
            "row": F.lit(None).cast(inner.dataType),
        }
    )
    rows = (
        texts.unionByName(spans)
        .select("part", "doc", "tags", "docs", "counts", "made", "text", "row")
        .repartition(tasks, "part")
        .sortWithinPartitions("part", F.col("docs").isNull())
    )
    return rows.mapInArrow(releasing(run), schema).select(
        *[F.col("text" if name == "text" else f"row.`{name}`") for name in docs.columns],
        F.struct("n_bytes", "n_removed", "n_spans", "kept_sha256").alias("repeats"),
    )
