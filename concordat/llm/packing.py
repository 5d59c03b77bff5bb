"""Packing of documents into sequences by a grouping genetic algorithm.

Pieces are dealt into islands of bounded size.  On an island a population of packings evolves: a
child takes over whole well-filled sequences of one parent, keeps what the other parent has beside
them, and puts what that displaces where it fits best.  Between epochs each island sends its elite,
the sequences filled to the brim, as patterns of lengths to the next island, which builds them from
its own pieces; at last the worst-filled sequences of all islands are packed once more together.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.byte_bpe import encoder, little_endian, shared_spec
from concordat.llm.common import releasing, staged, text_or_empty

ISLAND = 8192  # pieces on an island, about
POPULATION = 5
GENERATIONS = 6
ELITE = 64  # patterns that an island sends on
WORST = 48  # sequences of an island that are packed again at last

PIECE = "doc_id {}, piece int, start long, length long, ids_crc32 long"


# --- pieces ------------------------------------------------------------------------------------


def token_pieces(docs: DataFrame, spec: str, capacity: int, end: int) -> DataFrame:
    """Each document's ids and the ``end`` id, cut where longer than ``capacity``.

    The ids are the library's own: the string of an added token, as <|endoftext|>, is that token.
    The first piece of a long document takes what full pieces leave over.
    """
    sent = shared_spec(docs.sparkSession, spec)
    last = np.asarray([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(sent.value, little_endian, added=True)
        for batch in batches:
            found = []
            texts = (raw for (some,) in encode_texts(batch.column(1)) for raw in some)
            for row, raw in enumerate(texts):
                ids = bytes(raw) + last
                total = len(ids) // 4
                start, upto = 0, total % capacity or capacity
                for piece in range(math.ceil(total / capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * upto])
                    found.append((row, piece, start, upto - start, crc))
                    start, upto = upto, upto + capacity
            rows, *rest = (np.array(column) for column in zip(*found)) if found else [[]] * 5
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(column, kind) for column, kind in zip(rest, kinds)]
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, *columns], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        releasing(run, encoder), PIECE.format(kind)
    )


# --- one island --------------------------------------------------------------------------------


class Packing:
    """Sequences under construction: which one holds each piece, and how full each is."""

    def __init__(self, lengths: np.ndarray, capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.holder = np.full(len(lengths), -1)
        self.fills: list[int] = []
        # Sequences by free room, and the set of rooms that occur as the bits of a number.
        self._by_room: dict[int, list[int]] = defaultdict(list)
        self._rooms = 0

    def _offer(self, sequence: int) -> None:
        room = self.capacity - self.fills[sequence]
        if room:
            self._by_room[room].append(sequence)
            self._rooms |= 1 << room

    def open(self, pieces: np.ndarray) -> None:
        """A sequence of just these pieces."""
        self.holder[pieces] = len(self.fills)
        self.fills.append(int(self.lengths[pieces].sum()))
        self._offer(len(self.fills) - 1)

    def adopt(self, holder: np.ndarray) -> None:
        """The sequences of another packing, for its pieces that have one."""
        held = np.flatnonzero(holder >= 0)
        _, renamed = np.unique(holder[held], return_inverse=True)
        base = len(self.fills)
        self.holder[held] = base + renamed
        fills = np.bincount(renamed, self.lengths[held]).astype(int)
        for fill in fills.tolist():
            self.fills.append(fill)
            self._offer(len(self.fills) - 1)

    def best_fit(self, pieces: np.ndarray) -> None:
        """The pieces in the given order, each where it leaves the least room."""
        by_room, fills, lengths = self._by_room, self.fills, self.lengths[pieces].tolist()
        for piece, length in zip(pieces.tolist(), lengths):
            fitting = self._rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                sequence = by_room[room].pop()
                if not by_room[room]:
                    self._rooms ^= 1 << room
            else:
                sequence = len(fills)
                fills.append(0)
            fills[sequence] += length
            self.holder[piece] = sequence
            self._offer(sequence)

    def fitness(self) -> tuple[int, float]:
        """Few sequences first, then fill gathered in few of them."""
        fills = np.asarray(self.fills, float) / self.capacity
        return -len(fills), float(np.square(fills).sum())


def _descending(pieces: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return pieces[np.argsort(-lengths[pieces], kind="stable")]


def crossed(mother: Packing, given: np.ndarray, rng: np.random.Generator) -> Packing:
    """``mother`` with the whole sequences ``given`` (a number for each piece, else -1) put in.

    Her sequences that lose a piece to them are broken up, and so are a few of the emptiest; what
    they still hold is displaced and put back, longest first, where it fits best.
    """
    child = Packing(mother.lengths, mother.capacity)
    child.adopt(given)
    fills = np.asarray(mother.fills)
    broken = np.zeros(len(fills), bool)
    broken[mother.holder[given >= 0]] = True
    emptiest = np.argsort(fills + rng.integers(0, 64, len(fills)), kind="stable")
    broken[emptiest[: max(2, len(fills) // 50)]] = True
    rest = np.where(broken[mother.holder] | (given >= 0), -1, mother.holder)
    child.adopt(rest)
    child.best_fit(_descending(np.flatnonzero((rest < 0) & (given < 0)), mother.lengths))
    return child


def _well_filled(father: Packing, rng: np.random.Generator) -> np.ndarray:
    """About half of the father's best-filled sequences, as a number for each piece, else -1."""
    fills = np.asarray(father.fills)
    good = fills >= np.quantile(fills, 0.5)
    good &= rng.random(len(fills)) < 0.5
    return np.where(good[father.holder], father.holder, -1)


def _from_patterns(lengths: np.ndarray, patterns: list, capacity: int) -> np.ndarray:
    """Sequences of foreign patterns, built once each from pieces of those lengths."""
    stock = defaultdict(list)
    for piece, length in enumerate(lengths.tolist()):
        stock[length].append(piece)
    given = np.full(len(lengths), -1)
    for number, pattern in enumerate(patterns):
        wanted = [(length, pattern.count(length)) for length in set(pattern)]
        if all(len(stock[length]) >= count for length, count in wanted):
            for length, count in wanted:
                given[[stock[length].pop() for _ in range(count)]] = number
    return given


def evolved(lengths: np.ndarray, capacity: int, seed: int, holder=None, patterns=()) -> np.ndarray:
    """The best packing found of pieces of these lengths, as a sequence number for each."""
    rng = np.random.default_rng(seed)
    every = np.arange(len(lengths))
    people = []
    for n in range(POPULATION):
        one = Packing(lengths, capacity)
        if n == 0 and holder is not None:
            one.adopt(holder)
        else:
            noise = rng.integers(0, 1 + n * capacity // 16, len(lengths)) if n else 0
            one.best_fit(every[np.argsort(-(lengths + noise), kind="stable")])
        people.append(one)
    if len(patterns):
        given = _from_patterns(lengths, list(patterns), capacity)
        people.append(crossed(people[0], given, rng))
    least = max(1, math.ceil(lengths.sum() / capacity))
    for _ in range(GENERATIONS):
        people.sort(key=Packing.fitness, reverse=True)
        people = people[:POPULATION]
        if len(people[0].fills) <= least:
            break
        mother, father = (people[i] for i in rng.choice(len(people), 2, replace=len(people) < 2))
        people.append(crossed(people[0], _well_filled(father, rng), rng))
        people.append(crossed(mother, _well_filled(people[0], rng), rng))
    return max(people, key=Packing.fitness).holder


def _island(capacity: int):
    """Pieces with ``island`` and, from the second epoch on, ``sequence`` and the migrants.

    Rows stay in Arrow, where a column with nulls keeps its kind, so ids of any size stay exact.
    """

    def run(rows: pa.Table) -> pa.Table:
        patterns = [p for p in rows["pattern"].to_pylist() if p is not None]
        rows = rows.filter(pc.is_valid(rows["length"]))
        order = [(name, "ascending") for name in ("length", "doc_id", "piece", "start", "ids_crc32", "copy")]
        rows = rows.take(pc.sort_indices(rows, order))
        lengths = rows["length"].to_numpy().astype(np.int64)
        small = np.flatnonzero(lengths < capacity)
        holder = np.full(len(rows), -1)
        if len(small):
            known = rows["sequence"].take(pa.array(small))
            before = None if known.null_count else known.to_numpy().astype(np.int64)
            island = rows["island"][0].as_py()
            holder[small] = evolved(lengths[small], capacity, island, before, patterns)
        whole = np.flatnonzero(lengths >= capacity)
        holder[whole] = holder.max(initial=-1) + 1 + np.arange(len(whole))
        at = rows.schema.get_field_index("sequence")
        rows = rows.set_column(at, "sequence", pa.array(holder, pa.int64()))
        return rows.drop_columns(["pattern"])

    return run


# --- islands together --------------------------------------------------------------------------


def _with_copies(pieces: DataFrame) -> DataFrame:
    """The pieces with ``copy``, a number within rows that are the same in all columns.

    Such rows are folded and told apart again in bounded steps, so no task holds all of them.
    """
    folded = pieces.groupBy(*pieces.columns).agg(F.count("*").alias("n"))
    blocks = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / ISLAND))
    first = F.col("block") * ISLAND
    copies = F.sequence(first, F.least(F.col("n"), first + ISLAND) - 1)
    return (
        folded.withColumn("block", F.explode(blocks))
        .withColumn("copy", F.explode(copies))
        .drop("n", "block")
    )


def pack(docs: DataFrame, spec: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset``.

    ``docs`` has ``doc_id`` and ``text``; other columns are left out.  Only documents longer than
    ``capacity`` are cut.  A missing or empty text is a piece of the ``end`` id alone.  Repeated rows
    are packed each for itself, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = staged(token_pieces(docs, spec, capacity, end), "pieces")
    islands = max(1, math.ceil(pieces.count() / ISLAND))
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # Whatever ids repeat or miss, pieces spread evenly over islands by all that tells them apart.
    told = [*own, "copy"]
    schema = f"{PIECE.format(docs.schema['doc_id'].dataType.simpleString())}, copy long, island int, sequence long"

    def epoch(rows: DataFrame) -> DataFrame:
        return rows.groupBy("island").applyInArrow(_island(capacity), schema)

    dealt = _with_copies(pieces).select(
        *told,
        F.pmod(F.xxhash64(*told), F.lit(islands)).cast("int").alias("island"),
        F.lit(None).cast("long").alias("sequence"),
        F.lit(None).cast("array<int>").alias("pattern"),
    )
    first = staged(epoch(dealt), "packed")
    # A sequence has at most ``capacity`` pieces, and an island sends a bounded number of patterns.
    sequences = (
        first.where(F.col("length") < capacity)
        .groupBy("island", "sequence")
        .agg(F.sum("length").alias("fill"), F.sort_array(F.collect_list(F.col("length").cast("int"))).alias("pattern"))
    )
    brim = sequences.where(F.col("fill") == capacity).groupBy("island", "pattern").count()
    by_count = Window.partitionBy("island").orderBy(F.desc("count"), "pattern")
    elite = brim.withColumn("nth", F.row_number().over(by_count)).where(F.col("nth") <= ELITE)
    migrants = elite.select(
        F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), "pattern"
    )
    second = staged(epoch(first.unionByName(migrants, allowMissingColumns=True)), "packed")
    fills = second.groupBy("island", "sequence").agg(F.sum("length").alias("fill"))
    by_fill = Window.partitionBy("island").orderBy("fill", "sequence")
    worst = (
        fills.where(F.col("fill") < capacity)
        .withColumn("nth", F.row_number().over(by_fill))
        .where(F.col("nth") <= WORST)
        .select("island", "sequence", F.lit(True).alias("again"))
    )
    marked = staged(second.join(worst, ["island", "sequence"], "left"), "packed")
    loose = marked.where("again")
    merged = max(1, math.ceil(loose.count() / ISLAND))
    redealt = loose.select(
        *told,
        (islands + F.pmod(F.xxhash64(*told), F.lit(merged))).cast("int").alias("island"),
        F.lit(None).cast("long").alias("sequence"),
        F.lit(None).cast("array<int>").alias("pattern"),
    )
    packed = marked.where("again is null").select(*own, "island", "sequence").unionByName(
        epoch(redealt).select(*own, "island", "sequence")
    )
    inside = Window.partitionBy("island", "sequence").orderBy("doc_id", "piece", "start")
    before = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return packed.select(
        *own,
        (F.col("island") * F.lit(1 << 32) + F.col("sequence")).alias("sequence_id"),
        F.coalesce(before, F.lit(0)).alias("offset"),
    )
