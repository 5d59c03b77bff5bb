"""Exact join of documents whose sets of word n-grams are alike.

Sets are ordered by one global order, rare n-grams first.  Two sets that are alike enough share one
of their first few n-grams; documents meet there, never elsewhere.  Who meets is compared in prefix
trees: the sets that a document is compared with are stored in a trie, a walk down shares the
overlap counted so far, and subtrees that can no longer reach the threshold are cut off.

Documents with equal sets are one class from the start.  Each class first joins the family of one
leader that it meets.  A family is compared with its leader in a prefix tree and, through their few
differences from the leader, its members with each other, inside one task.  After that only classes
of different components that meet, that no family has compared and whose maps of the parities of
their elements allow it are paired, so a large group of copies is never expanded into pairs, and no
link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.bytescan import Texts, blocks, mixed, words
from concordat.llm.common import discard, partitions, releasing, staged, text_or_empty
from concordat.llm.components import components

# Counters of the frequency sketch, whatever the size of the corpus; each also sends one byte.
COUNTERS = 1 << 18
CHUNKS = 16
# An n-gram whose counter holds this many times the mean is put after all others.
HEAVY = 8
# Members of a family, and elements of their sets, that one task compares with each other, about.
FAMILY = 4096
FAMILY_ELEMENTS = 1 << 22
# Elements of a set that an edge of the tree holds.
EDGE = 32
PARTS = 4
# Bits of the map that tells whose texts are wanted, at most, and in a row of it.
MARKS = 1 << 27
_CHUNK = 1 << 13
# An n-gram is 48 bits of its hash, so that a block's texts and levels fit beside it.
_BITS = np.uint64(48)
_MASK = np.uint64((1 << 48) - 1)
_MOST = 1 << 10
# Bits of a set's parity map, in words of 64.
_MAP = [f"map{i}" for i in range(4)]


@dataclass(frozen=True)
class Likeness:
    """Sets of runs of ``words`` words, alike when ``percent`` hundredths of all runs are common."""

    words: int = 5
    percent: int = 80

    def prefix(self, size):
        """How many of a set's first elements must hold one that any set alike also has first."""
        return size - (self.percent * size + 99) // 100 + 1

    def fits(self, common: int, all_: int) -> bool:
        return 100 * common >= self.percent * all_

    def near_sizes(self, a: str, b: str) -> str:
        return f"100 * {a} >= {self.percent} * {b} and 100 * {b} >= {self.percent} * {a}"

    def within_reach(self, common: Column, a: Column, b: Column) -> Column:
        """Whether sets of these sizes can still be alike with so many common first elements."""

        def later(n: Column) -> Column:
            return F.ceil(self.percent * n / 100) - 1

        return common + F.greatest(later(a), later(b)) >= self._needed(a, b)

    def _needed(self, a: Column, b: Column) -> Column:
        return F.ceil(self.percent * (a + b) / (100 + self.percent))

    def maps_allow(self, one: str, other: str) -> Column:
        """Whether the parity maps differ in no more bits than alike sets in elements.

        Each element flips one bit, so sets differ in at least as many elements as maps in bits.
        """
        a, b = F.col(f"n{one}"), F.col(f"n{other}")
        bits = [F.bit_count(F.col(f"{m}{one}").bitwiseXOR(F.col(f"{m}{other}"))) for m in _MAP]
        return sum(bits[1:], bits[0]) <= a + b - 2 * self._needed(a, b)


def ngram_sets(
    block: Texts, size: int, order: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of ``size`` words of each text and its number, in the global order.

    ``order`` has the level of each counter; without it all levels are equal.
    """
    found = words(block, fold=True)
    hashes, texts = found.hashes, found.texts
    many = np.bincount(texts, minlength=block.number)
    opens = np.cumsum(many) - many
    grams, owners = [], []
    factors = mixed(np.arange(100, 100 + size)) | np.uint64(1)
    for length in range(1, size + 1):
        if length == size:
            last = size - 1
            heads = np.flatnonzero(texts[last:] == texts[: max(len(texts) - last, 0)])
        else:
            heads = opens[many == length]
        total = np.full(len(heads), length, np.uint64)
        for k in range(length):
            total += hashes[heads + k] * factors[k]
        grams.append(mixed(total))
        owners.append(texts[heads])
    gram = np.concatenate(grams) & _MASK
    text = np.concatenate(owners).astype(np.uint64)
    level = np.uint64(0) if order is None else order[counter(gram)].astype(np.uint64)
    keys = np.unique(text << np.uint64(53) | level << _BITS | gram)
    return keys & _MASK, (keys >> np.uint64(53)).astype(np.int64)


def counter(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(48 - 18)).astype(np.int64)


def set_classes(grams: np.ndarray, texts: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The size and a 64-bit digest of each text's set; equal sets have equal digests."""
    sizes = np.bincount(texts, minlength=number)
    total = np.zeros(number, np.uint64)
    np.add.at(total, texts, mixed(grams + np.uint64(77)))
    return sizes, mixed(total + sizes.astype(np.uint64)).view(np.int64)


def parity_maps(grams: np.ndarray, texts: np.ndarray, number: int) -> np.ndarray:
    """For each text the parity of how many elements fall on each of the map's bits."""
    bits = 64 * len(_MAP)
    places = (grams >> np.uint64(16)).astype(np.int64) % bits
    odd = np.bincount(texts * bits + places, minlength=number * bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").reshape(number, len(_MAP))


def planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of numbers, all first bytes before all second ones.

    Bytes that are zero in most numbers then lie side by side, and compress to next to nothing.
    """
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def of_planes(data: bytes, width: int) -> np.ndarray:
    values = np.zeros((len(data) // width, 8), np.uint8)
    values[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return values.view("<u8").reshape(-1)


def packed_set(grams: np.ndarray) -> bytes:
    """n-grams, in any order, as their differences modulo 2^48; sorted ones take least."""
    return planes(np.diff(grams, prepend=np.uint64(0)) & _MASK, 6)


def unpacked_set(data: bytes) -> np.ndarray:
    return np.cumsum(of_planes(data, 6), dtype=np.uint64) & _MASK


# --- passes over the texts -----------------------------------------------------------------------


def _described(docs: DataFrame, like: Likeness) -> DataFrame:
    """One row for each document with its set's size and class, and the sketch of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, ids = np.zeros(COUNTERS, np.int64), None
        for batch in batches:
            ids, sizes, classes = batch.schema.field(0).type, [], []
            maps = [np.zeros((0, len(_MAP)), np.int64)]
            for block in blocks(batch.column(1), most=_MOST):
                grams, texts = ngram_sets(block, like.words)
                counts += np.bincount(counter(grams), minlength=COUNTERS)
                size, digest = set_classes(grams, texts, block.number)
                sizes.append(size)
                classes.append(digest)
                maps.append(parity_maps(grams, texts, block.number))
            rows, maps = batch.num_rows, np.concatenate(maps)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.concatenate(sizes) if rows else [], pa.int64()),
                    pa.array(np.concatenate(classes) if rows else [], pa.int64()),
                    *[pa.array(column, pa.int64()) for column in maps.T],
                    pa.nulls(rows, pa.int32()),
                    pa.nulls(rows, pa.binary()),
                ],
                names,
            )
        if ids is not None:
            parts = [part.astype("<u4").tobytes() for part in np.split(counts, CHUNKS)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(CHUNKS, ids),
                    *[pa.nulls(CHUNKS, pa.int64()) for _ in ("n", "class", *_MAP)],
                    pa.array(range(CHUNKS), pa.int32()),
                    pa.array(parts, pa.binary()),
                ],
                names,
            )

    names = ["doc_id", "n", "class", *_MAP, "chunk", "counts"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    maps = ", ".join(f"{name} long" for name in _MAP)
    return docs.mapInArrow(
        releasing(run), f"doc_id {kind}, n long, class long, {maps}, chunk int, counts binary"
    )


def _levels(described: DataFrame) -> np.ndarray:
    """The level of each counter: 0 for most, more for each doubling beyond ``HEAVY`` means."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                here = np.frombuffer(counts, "<u8" if len(counts) * CHUNKS == 8 * COUNTERS else "<u4")
                total[chunk] = total.get(chunk, 0) + here.astype(np.uint64)
        if total:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(total), pa.int32()),
                    pa.array([t.astype("<u8").tobytes() for t in total.values()], pa.binary()),
                ],
                ["chunk", "counts"],
            )

    # The sketches of all tasks are summed chunk by chunk; the sum's size is fixed.
    sketches = described.where("chunk is not null").select("chunk", "counts")
    summed = sketches.mapInArrow(releasing(run), "chunk int, counts binary")
    summed = summed.repartition(CHUNKS, "chunk").mapInArrow(releasing(run), "chunk int, counts binary")
    counts = np.zeros(COUNTERS, np.uint64)
    width = COUNTERS // CHUNKS
    for row in summed.collect():
        counts[row.chunk * width : (row.chunk + 1) * width] = np.frombuffer(row.counts, "<u8")
    share = counts / (HEAVY * max(counts.mean(), 8.0))
    return np.clip(np.ceil(np.log2(np.maximum(share, 1))), 0, 31).astype(np.uint8)


def _meetings(docs: DataFrame, like: Likeness, order, parts: int) -> DataFrame:
    """The first n-grams of each set, packed into one row for each task, batch and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = order.value
        for batch in batches:
            found = []
            for block in blocks(batch.column(0), most=_MOST):
                grams, texts = ngram_sets(block, like.words, levels)
                sizes, classes = set_classes(grams, texts, block.number)
                opens = np.cumsum(sizes) - sizes
                first = np.arange(len(grams)) - opens[texts] < like.prefix(sizes)[texts]
                owner = texts[first]
                found.append((grams[first], classes[owner], sizes[owner]))
            if not found:
                continue
            grams, classes, sizes = (np.concatenate(part) for part in zip(*found))
            heavy = levels[counter(grams)] > 0
            spread = np.where(heavy, classes.view(np.uint64) >> np.uint64(8), np.uint64(0))
            part = ((mixed(grams) + spread) % np.uint64(parts)).astype(np.int64)
            places = np.lexsort((classes, grams, part))
            cuts = np.flatnonzero(np.diff(part[places], prepend=-1, append=parts))
            rows = [places[a:b] for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(part[row[0]]) for row in rows], pa.int32()),
                    pa.array([packed_set(grams[row]) for row in rows], pa.binary()),
                    pa.array([classes[row].astype("<i8").tobytes() for row in rows], pa.binary()),
                    pa.array([planes(sizes[row], 4) for row in rows], pa.binary()),
                ],
                ["part", "grams", "classes", "sizes"],
            )

    return docs.select("text").mapInArrow(
        releasing(run), "part int, grams binary, classes binary, sizes binary"
    )


def _live(packed: DataFrame, like: Likeness, order) -> DataFrame:
    """``gram``, ``class`` and ``n`` where another class of fitting size has the n-gram too.

    Heavy n-grams are spread over all parts and so cannot be judged here; they always pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ([], [], [])
        for batch in batches:
            grams, classes, sizes = (column.to_pylist() for column in batch.columns)
            found[0].extend(unpacked_set(data) for data in grams)
            found[1].extend(np.frombuffer(data, "<i8") for data in classes)
            found[2].extend(of_planes(data, 4).astype(np.int32) for data in sizes)
        if not found[0]:
            return
        grams, classes, sizes = (np.concatenate(part) for part in found)
        places = np.lexsort((classes, sizes, grams))
        grams, classes, sizes = grams[places], classes[places], sizes[places].astype(np.int64)
        fresh = np.append(True, (grams[1:] != grams[:-1]) | (classes[1:] != classes[:-1]))
        grams, classes, sizes = grams[fresh], classes[fresh], sizes[fresh]
        near = (grams[1:] == grams[:-1]) & (100 * sizes[:-1] >= like.percent * sizes[1:])
        live = np.append(near, False) | np.append(False, near)
        live |= order.value[counter(grams)] > 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(grams[live].astype(np.int64)),
                pa.array(classes[live]),
                pa.array(sizes[live], pa.int64()),
            ],
            ["gram", "class", "n"],
        )

    return packed.select("grams", "classes", "sizes").mapInArrow(
        releasing(run), "gram long, class long, n long"
    )


# --- who is compared with whom -------------------------------------------------------------------


def _enough(met: DataFrame, like: Likeness) -> DataFrame:
    """Pairs ``x``, ``y`` whose common first n-grams leave the threshold within reach."""
    counted = met.groupBy("x", "y", "nx", "ny").agg(F.count("*").alias("common"))
    return counted.where(like.within_reach(F.col("common"), F.col("nx"), F.col("ny")))


#: The columns that a class has, and what they begin with at either end of a pair.
_ENDS = [("class", ""), ("n", "n"), ("shared", "shared"), *[(name, name) for name in _MAP]]


def _first_pairs(live: DataFrame, like: Likeness) -> DataFrame:
    """Each class with the one leader that it shares most first n-grams with.

    At an n-gram the class that shares most of its first n-grams leads its band of sizes: the one in
    the middle of a group of copies rather than one that is itself much changed.
    """
    band = F.floor(F.log(F.col("n")) / math.log(100 / like.percent)).alias("band")
    rows = live.select("gram", "class", "n", "shared", band)
    lead = rows.groupBy("gram", "band").agg(
        F.max(F.struct("shared", "class", "n")).alias("lead"), F.count("*").alias("members")
    )
    lead = lead.where("members > 1").select(
        F.xxhash64("gram", "band").alias("meet"),
        F.col("lead.class").alias("y"),
        F.col("lead.n").alias("ny"),
    )
    rows = rows.select(
        F.xxhash64("gram", "band").alias("meet"), F.col("class").alias("x"), F.col("n").alias("nx")
    )
    near = _enough(rows.join(lead, "meet").where("x <> y"), like)
    best = near.groupBy("x").agg(F.max(F.struct("common", "y", "nx")).alias("best"))
    return best.select("x", F.col("best.y").alias("y"), F.col("best.nx").alias("nx"))


def _other_pairs(
    live: DataFrame, roots: DataFrame, families: DataFrame, like: Likeness
) -> tuple[DataFrame, DataFrame]:
    """Classes of different components that meet and that no family has compared, and the staged
    table of who meets.

    At each n-gram the component with most classes there stands aside: only the others' classes are
    paired, with all that are not of their own component.
    """
    named = live.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    own = families.select(
        F.col("x").alias("class"), F.col("y").alias("lead"), F.xxhash64("y", "group").alias("family")
    )
    named = named.join(own, "class", "left")
    counts = named.groupBy("gram", "root").agg(F.count("*").alias("n"))
    most = counts.groupBy("gram").agg(
        F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots")
    )
    most = most.where("roots > 1").select(
        F.xxhash64("gram").alias("meet"), F.col("most.root").alias("main")
    )
    mixed_ = staged(named.withColumn("meet", F.xxhash64("gram")).join(most, "meet"), "meetings")
    more = [("root", "r"), ("lead", "l"), ("family", "f")]
    minor = mixed_.where("root <> main").select(
        "meet", *[F.col(name).alias(f"{to}x") for name, to in more], *[F.col(name).alias(f"{to}x") for name, to in _ENDS]
    )
    every = mixed_.select(
        "meet", "main", *[F.col(name).alias(f"{to}y") for name, to in more], *[F.col(name).alias(f"{to}y") for name, to in _ENDS]
    )
    met = minor.join(every, "meet").where(
        F.expr(
            f"rx <> ry and (ry = main or x < y) and {like.near_sizes('nx', 'ny')}"
            " and not (fx <=> fy and fx is not null) and not lx <=> y and not ly <=> x"
        )
        # They have no more first n-grams in common than either one shares with anyone.
        & like.within_reach(F.least("sharedx", "sharedy"), F.col("nx"), F.col("ny"))
        & like.maps_allow("x", "y")
    )
    # Which of two components stands aside differs between n-grams; a pair is counted as one.
    low, high = F.least("x", "y"), F.greatest("x", "y")
    n_low = F.when(F.col("x") < F.col("y"), F.col("nx")).otherwise(F.col("ny"))
    n_high = F.when(F.col("x") < F.col("y"), F.col("ny")).otherwise(F.col("nx"))
    met = met.select(low.alias("x"), high.alias("y"), n_low.alias("nx"), n_high.alias("ny"))
    return _enough(met, like).select("x", "y", "nx"), mixed_


# --- comparison in prefix trees ------------------------------------------------------------------


class PrefixTree:
    """Ordered sets as paths of edges of ``EDGE`` elements; equal beginnings are stored once."""

    def __init__(self, like: Likeness) -> None:
        self._like = like
        self._children: list[dict[bytes, int]] = [{}]
        self._ends: list[list[int]] = [[]]
        self._longest: list[int] = [0]

    def insert(self, elements: np.ndarray, number: int) -> None:
        node, left = 0, len(elements)
        self._longest[0] = max(self._longest[0], left)
        for at in range(0, len(elements), EDGE):
            edge = elements[at : at + EDGE].tobytes()
            left -= len(edge) // 8
            below = self._children[node].get(edge)
            if below is None:
                below = self._children[node][edge] = len(self._children)
                self._children.append({})
                self._ends.append([])
                self._longest.append(0)
            node = below
            self._longest[node] = max(self._longest[node], left)
        self._ends[node].append(number)

    def overlaps(self, other: np.ndarray) -> Iterator[tuple[int, int]]:
        """The number and overlap of each stored set that is alike enough to ``other``.

        Sets that are alike have at least ``percent`` hundredths of either one in common, so a subtree goes as soon as the overlap so far and its longest remainder
        stay below that.
        """
        need = (self._like.percent * len(other) + 99) // 100
        sorted_other = np.sort(other)
        waiting = [(0, 0, 0)]
        while waiting:
            node, common, depth = waiting.pop()
            for number in self._ends[node]:
                if self._like.fits(common, depth + len(other) - common):
                    yield number, common
            for edge, below in self._children[node].items():
                part = np.frombuffer(edge, np.uint64)
                at = np.searchsorted(sorted_other, part)
                at[at == len(sorted_other)] = 0
                now = common + int((sorted_other[at] == part).sum())
                if now + self._longest[below] >= need:
                    waiting.append((below, now, depth + len(part)))


def _marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids``, and few others, without a shuffle of the texts.

    Every id of ``ids`` sets one bit of a map, at most ``MARKS`` in all, that all tasks get; other
    ids may share a bit, so that a join has to follow.
    """
    bits = min(max(1 << (128 * ids.count()).bit_length(), 8 * _CHUNK), MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            places = batch.column(0).to_numpy()
            for chunk in np.unique(places // _CHUNK).tolist():
                here = places[places // _CHUNK == chunk]
                maps.setdefault(chunk, np.zeros(_CHUNK, bool))[here % _CHUNK] = True
        if maps:
            data = [np.packbits(one).tobytes() for one in maps.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(maps), pa.int64()), pa.array(data, pa.binary())], ["chunk", "data"]
            )

    spark = docs.sparkSession
    places = ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("place"))
    dealt = places.repartition(partitions(spark), F.floor(F.col("place") / _CHUNK))
    marks = np.zeros(bits // 8, np.uint8)
    for row in dealt.mapInArrow(releasing(run), "chunk long, data binary").collect():
        at = row.chunk * _CHUNK // 8
        marks[at : at + _CHUNK // 8] = np.frombuffer(row.data, np.uint8)
    sent = spark.sparkContext.broadcast(marks)

    @F.arrow_udf("boolean")
    def marked(column: pa.Array) -> pa.Array:
        place = column.to_numpy(zero_copy_only=False) % bits
        return pa.array((sent.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool))

    return docs.where(marked(F.xxhash64("doc_id")))


def _texts(placed: DataFrame, docs: DataFrame, described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``placed`` with the ``text`` of the first document of its ``class``, and the staged table of
    these documents."""
    known = described.where("doc_id is not null").select("doc_id", "class")
    first = known.join(placed.select("class").distinct(), "class")
    first = staged(first.groupBy("class").agg(F.min("doc_id").alias("doc_id")), "firsts")
    return _marked(docs, first).join(placed.join(first, "class"), "doc_id"), first


def _families(pairs: DataFrame) -> DataFrame:
    """Pairs ``x``, ``y`` with the ``group`` of ``y``'s company, each of a size that a task can hold."""
    pairs = staged(pairs, "pairs")
    size = F.greatest(F.count("*") / FAMILY, F.sum("nx") / FAMILY_ELEMENTS)
    company = pairs.groupBy("y").agg(F.ceil(size).alias("groups"))
    company = company.select(F.xxhash64("y").alias("meet"), F.col("y").alias("leader"), "groups")
    dealt = pairs.withColumn("meet", F.xxhash64("y")).join(company, "meet").where("y = leader")
    group = F.pmod(F.xxhash64("x"), F.col("groups")).cast("int").alias("group")
    families = staged(dealt.select("x", "y", group), "families")
    discard(pairs)
    return families


def _alike_members(sets: list[np.ndarray], lead: np.ndarray, like: Likeness) -> list[tuple[int, int]]:
    """Links among the members of a family, all pairs, through their differences from the leader.

    Two sets differ where exactly one of them differs from the leader, so what members have in
    common of their differences, which are small, tells how far they are apart.
    """
    sizes = np.array([len(one) for one in sets])
    apart = [np.setxor1d(one, lead, assume_unique=True) for one in sets]
    owner = np.repeat(np.arange(len(sets)), [len(one) for one in apart])
    element = np.concatenate(apart)
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    bounds = np.append(np.flatnonzero(np.append(True, element[1:] != element[:-1])), len(element))
    common = np.zeros((len(sets), len(sets)), np.int32)
    shared = np.flatnonzero(np.diff(bounds) > 1)
    for at in range(0, len(shared), 512):
        some = shared[at : at + 512]
        holds = np.zeros((len(sets), len(some)), np.float32)
        for column, a, b in zip(range(len(some)), bounds[some], bounds[some + 1]):
            holds[owner[a:b], column] = 1
        common += (holds @ holds.T).astype(np.int32)
    width = np.array([len(one) for one in apart])
    found = []
    for i in range(len(sets) - 1):
        distance = width[i] + width[i + 1 :] - 2 * common[i, i + 1 :]
        total = sizes[i] + sizes[i + 1 :]
        # |union| and |intersection| are half of the sizes' sum plus and minus the distance.
        alike = 100 * (total - distance) >= like.percent * (total + distance)
        found += [(i, i + 1 + j) for j in np.flatnonzero(alike).tolist()]
    return found


def _spanning(links: list[tuple[int, int]], number: int) -> list[tuple[int, int]]:
    """Links that hold the same components together, fewer than there are members."""
    root = list(range(number))

    def top(one: int) -> int:
        while root[one] != one:
            root[one] = root[root[one]]
            one = root[one]
        return one

    kept = []
    for a, b in links:
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def _links(dealt, docs, described, like: Likeness, order, within: bool) -> DataFrame:
    """Pairs that are alike enough, as ``a`` and ``b``, out of ``dealt``: ``x``, ``y`` and ``group``.

    Each ``x`` is compared with its ``y``, and ``within`` also with all others of its group.
    """
    spark = docs.sparkSession
    members = dealt.select(F.col("x").alias("class"), "y", "group", "x")
    leaders = dealt.select("y", "group").distinct()
    leaders = leaders.select(F.col("y").alias("class"), "y", "group", F.lit(None).cast("long").alias("x"))
    placed = staged(members.unionByName(leaders), "placed")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            text, wanted = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            # A text that goes to several places stands in successive rows.
            again = pc.equal(text.slice(1), text.slice(0, len(text) - 1))
            fresh = np.append(True, ~again.to_numpy(zero_copy_only=False))
            data, classes = [], []
            for block in blocks(text.filter(pa.array(fresh)), most=_MOST):
                grams, owners = ngram_sets(block, like.words, order.value)
                sizes, found = set_classes(grams, owners, block.number)
                classes.append(found)
                data += [packed_set(part) for part in np.split(grams, np.cumsum(sizes)[:-1])]
            which = np.cumsum(fresh) - 1
            # Where documents share an id, only the text that has the class is meant, and once.
            keep = []
            for i in np.flatnonzero(np.concatenate(classes)[which] == wanted).tolist():
                place = tuple(batch.column(k)[i].as_py() for k in (2, 3, 4))
                if place not in seen:
                    seen.add(place)
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k).take(pa.array(keep, pa.int64())) for k in (2, 3, 4)],
                    pa.array([data[which[i]] for i in keep], pa.binary()),
                ],
                ["y", "group", "x", "elements"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, lead, names, sets, found = None, None, [], [], []

        def done() -> None:
            if lead is None or not sets:
                return
            tree = PrefixTree(like)
            for number, one in enumerate(sets):
                tree.insert(one, number)
            number = len(sets)
            links = [(i, number) for i, _ in tree.overlaps(lead)]
            if within and len(links) < number > 1:
                links += _alike_members(sets, lead, like)
            ends = [*names, here[0]]
            found.extend((ends[a], ends[b]) for a, b in _spanning(links, number + 1))

        for batch in batches:
            for y, group, x, data in zip(*(column.to_pylist() for column in batch.columns)):
                if (y, group) != here:
                    done()
                    here, lead, names, sets = (y, group), None, [], []
                elements = unpacked_set(data)
                if x is None:
                    lead = elements
                elif not names or names[-1] != x:
                    sets.append(elements)
                    names.append(x)
        done()
        a, b = zip(*found) if found else ([], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
        )

    texts, first = _texts(placed, docs, described)
    texts = texts.select("text", "class", "y", "group", "x")
    rows = texts.mapInArrow(releasing(sets_of), "y long, group int, x long, elements binary")
    rows = rows.repartition(partitions(spark), "y", "group")
    rows = rows.sortWithinPartitions("y", "group", F.col("x").asc_nulls_first())
    links = staged(rows.mapInArrow(releasing(run), "a long, b long"), "links")
    discard(placed, first)
    return links


# --- the operator --------------------------------------------------------------------------------


def join_alike(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``class_id`` and ``component_id`` for each row of ``docs``.

    A document's set holds its distinct runs of ``words`` words, A-Z lower-cased, words parted by
    blanks; with fewer words the whole text is one run.  Two documents link when their common runs
    are at least ``percent`` hundredths of all their runs.  ``component_id`` is the smallest id
    reachable by links.  Documents without words have an empty set and link with nothing; so do
    rows without an id, whose component is missing.  Equal sets always link.  ``docs`` needs
    ``doc_id`` and ``text``; other columns are left out, repeated rows stay repeated, and an empty
    table gives an empty result.
    """
    spark, like = docs.sparkSession, Likeness(words, percent)
    docs = docs.select("doc_id", text_or_empty().alias("text"))
    described = staged(_described(docs, like), "described")
    known = described.where("chunk is null").select("doc_id", "n", "class", *_MAP)
    order = spark.sparkContext.broadcast(_levels(described))
    parts = partitions(spark)
    named = docs.where("doc_id is not null")
    packed = _meetings(named, like, order, PARTS * parts).repartition(parts, "part")
    maps = known.groupBy(F.col("class").alias("of")).agg(*[F.min(m).alias(m) for m in _MAP])
    live = staged(_live(packed, like, order), "live")
    shared = live.groupBy(F.col("class").alias("of")).agg(F.count("*").alias("shared"))
    facts = maps.join(shared, "of")
    bare, live = live, staged(live.join(facts, F.col("class") == F.col("of")).drop("of"), "live")
    discard(bare)
    families = _families(_first_pairs(live, like))
    links = _links(families, named, known, like, order, within=True)
    pairs, meetings = _other_pairs(live, components(links), families, like)
    others = _families(pairs)
    discard(live, families, meetings)
    more = _links(others, named, known, like, order, within=False)
    roots = components(links.unionByName(more))
    discard(others, links, more)
    classes = (
        known.where("n > 0 and doc_id is not null")
        .groupBy("class")
        .agg(F.min("doc_id").alias("first"))
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    least = least.select(F.xxhash64("root").alias("meet"), "component_id")
    classes = classes.withColumn("meet", F.xxhash64("root")).join(least, "meet")
    classes = classes.select(F.xxhash64("class").alias("meet"), F.col("first"), F.col("component_id"))
    # Only documents that have words and an id look for their class.
    linked = F.when(F.col("n") > 0, F.xxhash64("class"))
    rows = known.withColumn("meet", F.when(F.col("doc_id").isNotNull(), linked))
    return rows.join(classes, "meet", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("first", "doc_id").alias("class_id"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
