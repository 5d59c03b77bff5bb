"""Phrases that belong together, mined from a weighted de Bruijn graph of words.

Nodes are runs of three words of one language, edges runs of four: an edge leads from its first
three words to its last three and weighs as much as the run occurs.  Only edges, and the ends of
pieces, are counted in the texts.  The weight of a node is what flows out of it plus the pieces that
end there, and the counts of two words follow from the nodes in the same way.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.common import partitions, staged, text_or_empty

LONGEST = 4
# Text counted at once, and text whose edges make up one part of the graph.
CHUNK_BYTES = 2 * 1024 * 1024
PART_BYTES = 4 * 1024 * 1024
# Documents whose word pairs tell which pairs are too common for one part: balance only.
PAIR_SAMPLE = 4096
HOT_PAIRS = 1024
# Bytes at each end of a word that its hash looks at.
OUTER_BYTES = 8
# Every so many nodes a path is cut, so that no path, and no row, grows without end.
PATH_CUT = 64

# What ends a piece, what parts words, and the only letters that are lower-cased.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"

_LOWERED = bytes.maketrans(UPPER, LOWER)
_BORDER = re.compile(b"[" + re.escape(ENDS + BLANKS) + b"]")
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(ENDS)] = 2
_MIX = np.uint64(0x9E3779B97F4A7C15)

_PACKED = "lang string, part int, lines binary, counts binary"
_COUNTED = "lang string, words int, gram string, n long"


def _bytes(value: bytes) -> pa.Scalar:
    return pa.scalar(value, pa.large_binary())


class _Words:
    """The words of a buffer as numbers, the piece each stands in, and whether the last one is open."""

    def __init__(self, buffer: bytes):
        kind = _KIND[np.frombuffer(buffer, np.uint8)]
        inside = kind == 0
        step = np.diff(inside.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        data = np.frombuffer(buffer, np.uint8)[inside]
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        self.names = words.dictionary
        self.ids = words.indices.to_numpy().astype(np.int64)
        breaks = np.cumsum(kind == 2, dtype=np.int64)
        self.piece = breaks[starts]
        self.open = len(starts) > 0 and breaks[-1] == self.piece[-1]

    def named(self, ids: np.ndarray, end: bytes = b"") -> pa.Array:
        """The words of every row of numbers, joined by blanks."""
        last = pc.binary_join_element_wise(self.names, _bytes(end), _bytes(b""))
        columns = [self.names.take(pa.array(column)) for column in ids.T[:-1]]
        return pc.binary_join_element_wise(*columns, last.take(pa.array(ids.T[-1])), _bytes(b" "))

    def hashes(self, lang: str) -> np.ndarray:
        """A number for every word from its length and its outer bytes; it only deals out work."""
        offsets = np.frombuffer(self.names.buffers()[1], np.int64)[: len(self.names) + 1]
        data = np.frombuffer(self.names.buffers()[2], np.uint8)
        starts, sizes = offsets[:-1], np.diff(offsets)
        key = sizes.astype(np.uint64) + np.uint64(zlib.crc32(lang.encode()))
        for j in range(OUTER_BYTES):
            inside = j < sizes
            for at in (starts + j, starts + sizes - 1 - j):
                byte = data[np.where(inside, at, 0)]
                key = key * _MIX + np.where(inside, byte, 0).astype(np.uint64)
        return key ^ (key >> np.uint64(31))


def _codes(ids: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for every distinct row of word numbers, and a row that has it."""
    code = ids[:, 0]
    for column in ids.T[1:-1]:
        code = np.unique(code * many + column, return_inverse=True)[1]
    if ids.shape[1] > 1:
        code = code * many + ids[:, -1]
    found, code = np.unique(code, return_inverse=True)
    first = np.empty(len(found), np.int64)
    first[code] = np.arange(len(code))
    return code, first


def _summed(code: np.ndarray, size: int, counts: np.ndarray) -> np.ndarray:
    total = np.zeros(size, np.int64)
    np.add.at(total, code, counts)
    return total


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * _MIX + second
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    return mixed ^ (mixed >> np.uint64(32))


def _part_of(ids: np.ndarray, hashes: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """Runs with the same first two words share a part; those of a hot pair go by three words."""
    if ids.shape[1] == 1:
        key = _pair_hash(hashes[ids[:, 0]], np.uint64(0))
    else:
        key = _pair_hash(hashes[ids[:, 0]], hashes[ids[:, 1]])
        if ids.shape[1] > 2 and len(hot):
            spread = _pair_hash(key, hashes[ids[:, 2]])
            key = np.where(np.isin(key, hot), spread, key)
    return (key % np.uint64(parts)).astype(np.int64)


def _runs(words: _Words, carried: int, closed: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct edges, ends of three and of two words, and words, each with its counts.

    The first ``carried`` words only lead into what follows; unless ``closed``, an open last piece
    goes on elsewhere and does not end here.
    """
    ids, piece = words.ids, words.piece
    if not len(ids):
        return []
    last = np.append(piece[1:] != piece[:-1], closed or not words.open)
    found = []
    for length in range(LONGEST, 1, -1):
        at = np.arange(len(ids) - length + 1)
        if len(at):
            same = piece[: len(at)] == piece[length - 1 :]
            at = at[same] if length == LONGEST else at[same & last[length - 1 :]]
        if len(at):
            rows = ids[at[:, None] + np.arange(length)]
            code, first = _codes(rows, len(words.names))
            found.append((rows[first], np.bincount(code)))
    often = np.bincount(ids[carried:], minlength=len(words.names))
    seen = np.flatnonzero(often)
    if len(seen):
        found.append((seen[:, None], often[seen]))
    return found


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, _Words, int, bool]]:
    """Texts gathered by language to about ``size`` bytes; longer ones cut between words."""
    waiting: dict[str, list[bytes]] = {}
    held = 0

    def flushed():
        for lang, texts in waiting.items():
            yield lang, _Words(b"\n".join(texts)), 0, True
        waiting.clear()

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang, text in zip(langs, batch.column(1).cast(pa.large_binary())):
            text = text.as_py().translate(_LOWERED)
            if len(text) > size:
                yield from _cut(lang, text, size)
                continue
            waiting.setdefault(lang, []).append(text)
            held += len(text) + 1
            if held >= size:
                yield from flushed()
                held = 0
    yield from flushed()


def _cut(lang: str, text: bytes, size: int) -> Iterator[tuple[str, _Words, int, bool]]:
    """One long text in chunks; each begins with the last words of an unfinished piece."""
    low, lead = 0, []
    while low < len(text):
        border = _BORDER.search(text, low + size) if low + size < len(text) else None
        high = border.end() if border else len(text)
        words = _Words(b" ".join([*lead, text[low:high]]))
        yield lang, words, len(lead), high == len(text)
        lead = []
        if words.open:
            ids = words.ids[words.piece == words.piece[-1]][1 - LONGEST :]
            lead = words.names.take(pa.array(ids)).to_pylist()
        low = high


def _packed(
    batches: Iterator[pa.RecordBatch], hot: np.ndarray, parts: int, size: int
) -> Iterator[pa.RecordBatch]:
    """For each chunk and part one row: runs of one to four words by line, and their counts."""
    for lang, words, carried, closed in _chunks(batches, size):
        lines: dict[int, list[bytes]] = {}
        counts: dict[int, list[np.ndarray]] = {}
        hashes = words.hashes(lang)
        for rows, often in _runs(words, carried, closed):
            part = _part_of(rows, hashes, hot, parts)
            order = np.argsort(part, kind="stable")
            named = words.named(rows[order], b"\n")
            offsets = np.frombuffer(named.buffers()[1], np.int64)[: len(named) + 1]
            data = memoryview(named.buffers()[2])
            often = often[order]
            there, starts = np.unique(part[order], return_index=True)
            bounds = [*starts.tolist(), len(part)]
            places = offsets[bounds].tolist()
            for i, p in enumerate(there.tolist()):
                lines.setdefault(p, []).append(bytes(data[places[i] : places[i + 1]]))
                counts.setdefault(p, []).append(often[bounds[i] : bounds[i + 1]])
        if lines:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(lines)),
                    pa.array(list(lines), pa.int32()),
                    pa.array([_squeezed(b"".join(lines[p])) for p in lines], pa.binary()),
                    pa.array(
                        [_squeezed(np.concatenate(counts[p]).astype(np.int64).tobytes()) for p in lines],
                        pa.binary(),
                    ),
                ],
                names=["lang", "part", "lines", "counts"],
            )


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unsqueezed(data: bytes) -> bytes:
    return pa.decompress(
        data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True
    )


def _merged(
    batches: Iterator[pa.RecordBatch], hot: np.ndarray, least: int
) -> Iterator[pa.RecordBatch]:
    """The graph of each part: runs that occur often enough, and the words in all (0 words)."""
    here, lines, counts = None, [], []
    for batch in batches:
        for i in range(batch.num_rows):
            key = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            if key != here and lines:
                yield from _weighed(here[0], b"".join(lines), np.concatenate(counts), hot, least)
                lines, counts = [], []
            here = key
            lines.append(_unsqueezed(batch.column(2)[i].as_py()))
            counts.append(np.frombuffer(_unsqueezed(batch.column(3)[i].as_py()), np.int64))
    if lines:
        yield from _weighed(here[0], b"".join(lines), np.concatenate(counts), hot, least)


def _weighed(
    lang: str, text: bytes, counts: np.ndarray, hot: np.ndarray, least: int
) -> Iterator[pa.RecordBatch]:
    words = _Words(text)
    starts = np.flatnonzero(np.diff(words.piece, prepend=-1))
    lengths = np.diff(starts, append=len(words.ids))
    hashes = words.hashes(lang)
    for length in range(1, LONGEST + 1):
        # A run's weight: the longer runs that begin with it, and the pieces that end with it.
        flow = lengths == 1 if length == 1 else lengths >= length
        if not flow.any():
            continue
        rows = words.ids[starts[flow][:, None] + np.arange(length)]
        code, first = _codes(rows, len(words.names))
        total = _summed(code, len(first), counts[flow])
        often = total >= least
        if length == 2 and len(hot):
            # The nodes of a hot pair lie in several parts; the pair's weight is summed up later.
            often |= np.isin(_pair_hash(*hashes[rows[first]].T), hot)
        grams = words.named(rows[first][often])
        yield _rows(lang, length, grams, total[often])
        if length == 1:
            yield _rows(lang, 0, pa.array([b""], pa.large_binary()), total.sum(keepdims=True))


def _rows(lang: str, length: int, grams: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    size = len(grams)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * size, pa.string()),
            pa.array([length] * size, pa.int32()),
            grams.cast(pa.large_string()).cast(pa.string()),
            pa.array(counts, pa.int64()),
        ],
        names=["lang", "words", "gram", "n"],
    )


def _common_pairs(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Word pairs, by hash, that hold a good share of a chunk; -1 stands for all pairs."""
    for lang, words, _, _ in _chunks(batches, CHUNK_BYTES):
        same = words.piece[1:] == words.piece[:-1]
        hashes = words.hashes(lang)
        pairs = _pair_hash(hashes[words.ids[:-1][same]], hashes[words.ids[1:][same]])
        pair, often = np.unique(pairs, return_counts=True)
        good = often * 8 * parts >= len(pairs)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(pair[good].astype(np.int64), 0)),
                pa.array(np.append(np.zeros(good.sum(), bool), True)),
                pa.array(np.append(often[good], len(pairs)).astype(np.int64)),
            ],
            names=["pair", "whole", "n"],
        )


def _hot_pairs(texts: DataFrame, rows: int, parts: int) -> np.ndarray:
    """Hashes of word pairs that would overfill a part, by a sample of bounded size.

    Which pairs these are moves work between parts and never changes a count.
    """
    share = PAIR_SAMPLE / max(rows, 1)
    drawn = texts if share >= 1 else texts.sample(share, seed=11)
    told = drawn.mapInArrow(
        lambda batches: _common_pairs(batches, parts), "pair long, whole boolean, n long"
    )
    sums = told.groupBy("pair", "whole").agg(F.sum("n").alias("n"))
    top = sums.orderBy(F.desc("whole"), F.desc("n"), "pair").limit(HOT_PAIRS + 1).collect()
    whole = sum(row.n for row in top if row.whole)
    hot = [row.pair for row in top if not row.whole and row.n * 4 * parts >= whole]
    return np.sort(np.array(hot, np.int64).astype(np.uint64))


def count_phrases(docs: DataFrame, least: int = 30) -> DataFrame:
    """``lang``, ``words``, ``gram`` and ``n`` of all runs of one to four words that occur ``least``
    times or more; the row with 0 words holds the number of all words of the language."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    texts = docs.select(lang, text_or_empty().alias("text"))
    sizes = texts.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(partitions(docs.sparkSession), -(-(sizes[1] or 0) // PART_BYTES))
    hot = _hot_pairs(texts, sizes[0], parts)
    packed = texts.mapInArrow(lambda batches: _packed(batches, hot, parts, CHUNK_BYTES), _PACKED)
    gathered = packed.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "lang")
    counted = gathered.mapInArrow(lambda batches: _merged(batches, hot, least), _COUNTED)
    whole = counted.groupBy("lang", "words", "gram").agg(F.sum("n").alias("n"))
    return whole.where((F.col("words") == 0) | (F.col("n") >= least))


def _first(gram: str, words: int) -> Column:
    return F.substring_index(gram, " ", words)


def _last(gram: str, words: int) -> Column:
    return F.substring_index(gram, " ", -words)


def _linked(edges: DataFrame) -> DataFrame:
    """Every node that only follows one node, itself with no other way on: its path's first node
    (``head``), its place and the weight of the edge into it.

    Pointers double until the nodes that still move are those of circles; these stay alone.  Paths
    begin anew at every node whose hash says so, which bounds their length and the rounds.
    """
    ways = F.count("*").alias("ways")
    out = edges.groupBy("lang", "before").agg(ways, F.max("after").alias("after"), F.max("n").alias("n"))
    into = edges.groupBy("lang", "after").agg(ways, F.max("before").alias("before"))
    links = (
        out.where("ways = 1")
        .join(into.where("ways = 1").drop("ways"), ["lang", "before", "after"])
        .where("before <> after")
        .where(F.pmod(F.xxhash64("after"), F.lit(PATH_CUT)) != 0)
    )
    now = staged(
        links.select(
            "lang", F.col("after").alias("node"), F.col("before").alias("head"),
            F.lit(1).alias("place"), "n", F.lit(True).alias("moving"),
        ),
        "paths",
    )
    moving = None
    while True:
        ahead = now.select(
            "lang", F.col("node").alias("head"), F.col("head").alias("further"),
            F.col("place").alias("more"),
        )
        now = staged(
            now.join(ahead, ["lang", "head"], "left").select(
                "lang", "node", F.coalesce("further", "head").alias("head"),
                (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"), "n",
                F.col("further").isNotNull().alias("moving"),
            ),
            "paths",
        )
        left = now.where("moving").count()
        if left == 0 or left == moving:
            return now.where("not moving").drop("moving")
        moving = left


def compact_paths(grams: DataFrame) -> DataFrame:
    """The unary paths of the graph: per path the nodes in order, each with its text, its weight and
    the weight of the edge into it.  Nodes with several ways in or out, or on a circle, stay alone."""
    edges = grams.where(f"words = {LONGEST}").select(
        "lang", _first("gram", 3).alias("before"), _last("gram", 3).alias("after"), "n"
    )
    linked = _linked(edges)
    nodes = grams.where("words = 3").select("lang", F.col("gram").alias("node"), F.col("n").alias("weight"))
    placed = nodes.join(linked, ["lang", "node"], "left").select(
        "lang",
        F.coalesce("head", "node").alias("head"),
        F.struct(F.coalesce("place", F.lit(0)).alias("place"), "node", "weight", F.col("n").alias("into")).alias("at"),
    )
    return placed.groupBy("lang", "head").agg(F.sort_array(F.collect_list("at")).alias("nodes"))


def _on_paths(paths: DataFrame) -> DataFrame:
    """Phrases of three and four words that lie on a path, with what the path tells of them: the
    counts of a phrase's first and last three words, and the longer phrases around a node."""
    nodes = paths.select("lang", "nodes", F.posexplode("nodes").alias("i", "at"))
    before, after = F.get("nodes", F.col("i") - 1), F.get("nodes", F.col("i") + 1)
    none = F.lit(None).cast("long")
    node = F.struct(
        F.lit(3).alias("words"), F.col("at.node").alias("gram"), F.col("at.weight").alias("a"),
        none.alias("first3"), none.alias("last3"),
        F.greatest(F.col("at.into"), after["into"]).alias("around"),
    )
    edge = F.struct(
        F.lit(LONGEST).alias("words"),
        F.concat_ws(" ", before["node"], _last("at.node", 1)).alias("gram"),
        F.col("at.into").alias("a"),
        before["weight"].alias("first3"), F.col("at.weight").alias("last3"), none.alias("around"),
    )
    both = F.when(F.col("at.into").isNull(), F.array(node)).otherwise(F.array(node, edge))
    return nodes.select("lang", F.explode(both).alias("c")).select("lang", "c.*")


def _phrases(grams: DataFrame, paths: DataFrame) -> DataFrame:
    """All candidates: those of paths, the edges between paths and the pairs."""
    on_paths = _on_paths(paths)
    none = F.lit(None).cast("long")
    others = grams.where(f"words in (2, {LONGEST})").select(
        "lang", "words", "gram", F.col("n").alias("a"),
        none.alias("first3"), none.alias("last3"), none.alias("around"),
    )
    inner = on_paths.where(f"words = {LONGEST}").select("lang", "gram")
    return on_paths.unionByName(others.join(inner, ["lang", "gram"], "left_anti"))


def _uncovered(phrases: DataFrame, percent: int) -> DataFrame:
    """Phrases that no longer phrase holds nearly as often.  It is enough to look one word further:
    what holds a phrase in more words holds it in one word more, at least as often."""
    longer = phrases.where(f"words > 2 and not (words = {LONGEST} and first3 is not null)")
    parts = F.when(F.col("words") == 3, F.array(_first("gram", 2), _last("gram", 2))).otherwise(
        F.array(_first("gram", 3), _last("gram", 3))
    )
    held = longer.select("lang", F.explode(parts).alias("gram"), F.col("a").alias("held"))
    held = held.groupBy("lang", "gram").agg(F.max("held").alias("held"))
    most = F.coalesce(F.greatest("held", "around"), F.lit(0)).cast("decimal(20,0)")
    kept = phrases.join(held, ["lang", "gram"], "left")
    return kept.where(most * 100 < F.col("a").cast("decimal(20,0)") * percent).drop("held", "around")


def _scored(phrases: DataFrame, grams: DataFrame) -> DataFrame:
    """The lowest score among the cuts of each phrase, with its two counts."""

    def slot(name: str, part: Column) -> Column:
        return F.struct(F.lit(name).alias("slot"), part.alias("part"))

    ends = F.array(slot("first1", _first("gram", 1)), slot("last1", _last("gram", 1)))
    twos = F.array(slot("first2", _first("gram", 2)), slot("last2", _last("gram", 2)))
    threes = F.array(slot("first3", _first("gram", 3)), slot("last3", _last("gram", 3)))
    asked = (
        F.when(F.col("words") == 2, ends)
        .when((F.col("words") == 3) | F.col("first3").isNotNull(), F.concat(ends, twos))
        .otherwise(F.concat(ends, twos, threes))
    )
    asking = phrases.select("*", F.explode(asked).alias("ask")).select("*", "ask.*").drop("ask")
    known = grams.where("words > 0").select("lang", F.col("gram").alias("part"), "n")
    met = asking.join(known, ["lang", "part"])
    told = [
        F.coalesce(
            F.max(F.when(F.col("slot") == name, F.col("n"))),
            *([F.max(name)] if name.endswith("3") else []),
        ).alias(name)
        for name in ("first1", "last1", "first2", "last2", "first3", "last3")
    ]
    whole = met.groupBy("lang", "gram").agg(F.max("words").alias("words"), F.max("a").alias("a"), *told)

    def cut(k: int, left: str, right: str) -> Column:
        l, r = F.col(left), F.col(right)
        score = F.call_function(
            "div",
            F.col("a").cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(7,0)"),
            l.cast("decimal(20,0)") + r.cast("decimal(20,0)"),
        )
        return F.struct(
            score.cast("long").alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")
        )

    best = (
        F.when(F.col("words") == 2, cut(1, "first1", "last1"))
        .when(F.col("words") == 3, F.least(cut(1, "first1", "last2"), cut(2, "first2", "last1")))
        .otherwise(
            F.least(cut(1, "first1", "last3"), cut(2, "first2", "last2"), cut(3, "first3", "last1"))
        )
    )
    return whole.withColumn("best", best).select("lang", F.col("gram").alias("phrase"), "a", "best.*")


def mine_phrases(
    docs: DataFrame, least: int = 30, percent: int = 80, top: int = 2000
) -> DataFrame:
    """The ``top`` phrases of each language by how much their words belong together.

    Texts (``text``, ``lang``) are lower-cased in A-Z and cut into pieces at ``.,;:!?`` and line
    ends, pieces into words at blanks and tabs.  A candidate has two to four words and occurs
    ``least`` times or more within pieces, overlaps included; its score is the least over its cuts
    of floor(2000000 a / (l + r)), ties going to the earlier cut.  Candidates that a longer one
    holds in at least ``percent`` of their occurrences go.  Equal scores are ordered by count and
    then by the bytes of the phrase.

    A missing text is empty and a missing language is ``und``; empty texts and tables add nothing.
    Repeated rows count as often as they stand there, whatever their ids; other columns are ignored.
    A text of any length counts as a whole.

    Texts are counted in chunks of bounded size; of each chunk every distinct run of four words
    travels once, packed with others of its part, so a run that is everywhere is no burden to one
    task.  Pairs too common for a part are spread by their third word.
    """
    grams = staged(count_phrases(docs, least), "phrases")
    paths = staged(compact_paths(grams), "paths")
    kept = _uncovered(staged(_phrases(grams, paths), "phrases"), percent)
    totals = grams.where("words = 0").select("lang", F.col("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = _scored(kept, grams).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
