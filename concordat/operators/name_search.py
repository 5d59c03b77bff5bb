"""The most similar name for every name, exactly, as a chain of joins.

A first score for each name comes from names with which it shares a word.  That score bounds how
many letters may differ, and so which names are still worth comparing: names that differ in few
letters must share an intact piece, which is an equi-join; the rest meet all names within bounds of length,
in blocks whose equal beginnings and endings are compared once, those that cannot reach a score already
known left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.functions.lcs import best_ratios, ratio_pairs
from concordat.functions.text import key_ratio
from concordat.operators.skew import fits_broadcast, lookup_join
from concordat.session import materialize

# Names that stand for a word when first scores are sought: any choice gives the same result.
SEEDS = 4
# Names with many letters in common that raise the first score.
CLOSEST = 32
# Names are cut for these numbers of differing letters, into pieces of so many letters at least.
DIFFERENCES = (1, 2, 4, 8)
SHORTEST_PIECE = 3
# Names that one probe meets at a time.
BLOCK_ROWS = 256
# Names, and letters of them, that a task compares whole, and how many it compares them with.
WHOLE_ROWS = 1 << 16
WHOLE_LETTERS = 1 << 21
ASKED_ROWS = 1 << 15
# Names, drawn by hash, that all who ask meet first (then eight times as many, and so on), and keys drawn
# for each block or part.
DRAWN_ROWS = 1 << 13
CUT_SAMPLE = 64

# Two different strings can only round up to 100 from this joint length on.
_ROUNDS_TO_EQUAL = 200
# Letters fall into classes; each class has so many bits in one of the words.
_CLASSES, _BITS, _IN_WORD = 37, 6, 10
# Bits of a name's hash that fit beside a share of letters.
_MARK = (1 << 42) - 1
_WORDS = -(-_CLASSES // _IN_WORD)
_MEASURES = ("length", *[f"word{i}" for i in range(_WORDS)], "more")


def measured(names: DataFrame) -> DataFrame:
    """Adds the length of ``key`` and its letter counts as bits: the n-th letter of a class sets the
    n-th bit of the class, and what exceeds the bits is counted in ``more``."""
    letters = F.array_sort(F.transform(F.split("key", ""), lambda c: F.pmod(F.ascii(c), F.lit(_CLASSES))))
    nth = F.transform("letters", lambda c, i: F.struct(
        c.alias("c"), (i - F.array_position("letters", c) + 1).cast("int").alias("n")
    ))

    def word(number: int) -> Column:
        inside = F.filter(
            "nth", lambda x: (F.floor(x["c"] / _IN_WORD) == number) & (x["n"] < _BITS)
        )
        place = lambda x: F.pmod(x["c"], F.lit(_IN_WORD)) * _BITS + x["n"]
        return F.aggregate(
            inside,
            F.lit(0).cast("long"),
            lambda bits, x: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place(x))),
        )

    counted = names.withColumn("letters", letters).withColumn("nth", nth)
    words = {f"word{i}": word(i) for i in range(_WORDS)}
    more = F.size(F.filter("nth", lambda x: x["n"] >= _BITS))
    return counted.withColumns({**words, "more": more, "length": F.length("key")}).drop("letters", "nth")


def _of(side: str, *more: str) -> Column:
    return F.struct(*more, *_MEASURES).alias(side)


def _shared(a: str, b: str) -> Column:
    """At least as many letters as the two names can have in common, in whatever order."""
    bits = [F.bit_count(F.col(f"{a}.word{i}").bitwiseAND(F.col(f"{b}.word{i}"))) for i in range(_WORDS)]
    return sum(bits, F.least(F.col(f"{a}.more"), F.col(f"{b}.more")))


def _reachable(a: str, b: str, score: str) -> Column:
    """Whether the pair can still score as much, by its lengths and letters."""
    total = F.col(f"{a}.length") + F.col(f"{b}.length")
    return (total - _shared(a, b) * 2) * 200 <= total * (F.lit(201) - F.col(score) * 2)


def _shortest(length: Column, score: Column) -> Column:
    return F.ceil(length * (score * 2 - 1) / (F.lit(401) - score * 2)).cast("int")


def _longest(length: Column, score: Column) -> Column:
    return F.floor(length * (F.lit(401) - score * 2) / (score * 2 - 1)).cast("int")


def _differing(length: Column, other: Column, score: Column) -> Column:
    """How many letters two names of these lengths may differ in to reach the score."""
    return F.floor((length + other) * (F.lit(201) - score * 2) / 200).cast("int")


def first_scores(asked: DataFrame, offered: DataFrame, least: int = 1) -> DataFrame:
    """Adds ``floor``: the best score with a few names that share a word, ``least`` where there are
    none, or none so good."""
    words = F.explode(F.array_distinct(F.split("key", " ")))
    by_word = offered.select("id", F.col("key").alias("other"), words.alias("word"))
    nth = F.row_number().over(Window.partitionBy("word").orderBy("id"))
    seeds = by_word.withColumn("nth", nth).where(F.col("nth") <= SEEDS)
    # At most SEEDS names a word.
    seeds = seeds.groupBy("word").agg(F.collect_list("other").alias("others"))
    met = lookup_join(asked.select("key", words.alias("word")), seeds, "word", "inner")
    pairs = met.select("key", F.explode("others").alias("other")).distinct()
    found = pairs.groupBy("key").agg(F.max(key_ratio(F.col("key"), F.col("other"))).alias("floor"))
    best = F.greatest(F.col("floor"), F.lit(least)).alias("floor")
    return asked.join(found, "key", "left").select(*asked.columns, best)


def _cut_for(length: Column, score: Column) -> Column:
    """The smallest of DIFFERENCES that covers what may differ, null where pieces get too short."""
    most = _differing(length, _longest(length, score), score)
    least = _shortest(length, score)
    found = F.lit(None).cast("int")
    for number in reversed(DIFFERENCES):
        fits = (most <= number) & (least >= SHORTEST_PIECE * (number + 1))
        found = F.when(fits, number).otherwise(found)
    return found


def _piece_start(length: Column, number: Column, cuts: Column) -> Column:
    return F.floor(number * length / (cuts + 1)).cast("int")


def _meet_key(cuts: Column, length: Column, number: Column, piece: Column) -> Column:
    return F.xxhash64(cuts, length, number, piece).alias("meet")


def _offered_pieces(offered: DataFrame) -> DataFrame:
    """Every name once for each piece of each way of cutting it."""
    ways = F.filter(
        F.array(*map(F.lit, DIFFERENCES)), lambda d: (d + 1) * SHORTEST_PIECE <= F.col("length")
    )
    cut = offered.withColumn("cuts", F.explode(ways))
    cut = cut.withColumn("number", F.explode(F.sequence(F.lit(0), F.col("cuts"))))
    length, number, cuts = F.col("length"), F.col("number"), F.col("cuts")
    start = _piece_start(length, number, cuts)
    piece = F.substring(F.col("key"), start + 1, _piece_start(length, number + 1, cuts) - start)
    return cut.select(_meet_key(cuts, length, number, piece), _of("item", "key", "id"))


def _asked_pieces(asked: DataFrame) -> DataFrame:
    """Every name once for each place where a piece of a similar name may stand in it."""
    length, score, cuts = F.col("length"), F.col("floor"), F.col("cuts")
    lengths = F.sequence(_shortest(length, score), _longest(length, score))
    probes = asked.withColumn("other", F.explode(lengths))
    probes = probes.withColumn("may", _differing(length, F.col("other"), score)).where(
        F.abs(length - F.col("other")) <= F.col("may")
    )
    probes = probes.withColumn("number", F.explode(F.sequence(F.lit(0), cuts)))
    other, number, may = F.col("other"), F.col("number"), F.col("may")
    start = _piece_start(other, number, cuts)
    size = _piece_start(other, number + 1, cuts) - start
    # What differs before the piece and after it is at least the difference of the lengths there.
    by = length - other
    least, most = F.ceil((by - may) / 2).cast("int"), F.floor((by + may) / 2).cast("int")
    places = F.filter(F.sequence(start + least, start + most), lambda p: (p >= 0) & (p + size <= length))
    probes = probes.withColumn("size", size).withColumn("place", F.explode(places))
    piece = F.substring(F.col("key"), F.col("place") + 1, F.col("size"))
    meet = _meet_key(cuts, other, number, piece)
    return probes.select(meet, "floor", _of("query", "key")).distinct()


def _dealt(rows: DataFrame) -> DataFrame:
    """Items of one key cut into ``blocks``."""
    block = F.pmod(F.xxhash64("item.key"), F.coalesce("blocks", F.lit(1))).cast("int")
    return rows.withColumn("block", block).drop("blocks")


def _sent(probes: DataFrame) -> DataFrame:
    """Queries sent to every block of their key."""
    every = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    return probes.withColumn("block", F.explode(every)).drop("blocks")


def _blocks() -> Column:
    return F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks")


def _pair() -> list[Column]:
    columns = {"key": "query.key", "other": "item.key", "id": "item.id"}
    return [F.col(column).alias(name) for name, column in columns.items()]


def _by_pieces(asked: DataFrame, offered: DataFrame) -> DataFrame:
    """``key``, ``other`` and ``id`` of the pairs that share a piece where it may stand.

    A piece with many names is split into blocks, and what asks for it goes to every block.
    """
    pieces, probes = _offered_pieces(offered), _asked_pieces(asked)
    many = pieces.groupBy("meet").count().where(F.col("count") > BLOCK_ROWS)
    sizes = materialize(many.select("meet", _blocks()))
    if fits_broadcast(sizes):
        sizes = F.broadcast(sizes)
        pieces, probes = pieces.join(sizes, "meet", "left"), probes.join(sizes, "meet", "left")
    else:
        pieces, probes = lookup_join(pieces, sizes, "meet"), lookup_join(probes, sizes, "meet")
    met = _sent(probes).join(_dealt(pieces), ["meet", "block"])
    return met.where(_reachable("query", "item", "floor")).select(*_pair()).distinct()


def _class(length: Column) -> Column:
    return F.floor(F.log2(length) * 4).cast("int")


def _class_sizes(offered: DataFrame) -> DataFrame:
    """Classes of lengths and their blocks: four rows for each doubling, never more than some 120."""
    counts = offered.groupBy(_class(F.col("length")).alias("class")).count()
    kinds = "class int, blocks int"
    return offered.sparkSession.createDataFrame(counts.select("class", _blocks()).collect(), kinds)


def _by_length(asked: DataFrame, offered: DataFrame, sizes: DataFrame) -> DataFrame:
    """``query``, ``item`` and ``floor`` of all pairs that lengths and letters let reach the floor."""
    sizes = F.broadcast(sizes)
    length, score = F.col("length"), F.col("floor")
    classes = F.sequence(
        _class(F.greatest(_shortest(length, score), F.lit(1))), _class(_longest(length, score))
    )
    probes = asked.select("floor", _of("query", "key"), F.explode(classes).alias("class"))
    rows = offered.select(_class(length).alias("class"), _of("item", "key", "id"))
    # Few cells, but long to work on: an explicit count keeps them from being merged by size.
    tasks = asked.sparkSession.sparkContext.defaultParallelism * 4
    left = _sent(probes.join(sizes, "class")).repartition(tasks, "class", "block")
    right = _dealt(rows.join(sizes, "class")).repartition(tasks, "class", "block")
    met = left.join(right.hint("shuffle_hash"), ["class", "block"])
    return met.where(_reachable("query", "item", "floor"))


def _raised(asked: DataFrame, offered: DataFrame, sizes: DataFrame) -> DataFrame:
    """A higher floor for each name: its best score with the names that share most letters with it,
    one of each of CLOSEST groups of names.

    Share and name are one number, the name by its hash, so that the maxima combine in memory; two
    names of one hash would both be compared.
    """
    mark = F.xxhash64("other").bitwiseAND(F.lit(_MARK))
    total = F.col("query.length") + F.col("item.length")
    share = F.floor(_shared("query", "item") * 2_000_000 / total).cast("long")
    met = _by_length(asked, offered, sizes).select(
        F.col("query.key").alias("key"), F.col("item.key").alias("other"), share.alias("share")
    )
    packed = met.select("key", mark.alias("mark"), (F.col("share") * (_MARK + 1) + mark).alias("best"))
    most = packed.groupBy("key", F.pmod("mark", F.lit(CLOSEST)).alias("group")).agg(
        F.max("best").alias("best")
    )
    close = most.select("key", F.col("best").bitwiseAND(F.lit(_MARK)).alias("mark"))
    known = offered.select(F.col("key").alias("other")).withColumn("mark", mark)
    score = F.max(key_ratio(F.col("key"), F.col("other"))).alias("reached")
    told = close.join(known, "mark").groupBy("key").agg(score)
    rest = [c for c in asked.columns if c != "floor"]
    return asked.join(told, "key", "left").select(*rest, F.greatest("floor", "reached").alias("floor"))


def _near_and_far(asked: DataFrame, offered: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Names that must share a piece with their best match, and the others."""
    scored = first_scores(asked, offered, least)
    scored = materialize(scored.withColumn("cuts", _cut_for(F.col("length"), F.col("floor"))))
    return scored.where("cuts is not null"), scored.where("cuts is null").drop("cuts")


def candidate_pairs(asked: DataFrame, offered: DataFrame, least: int = 1) -> DataFrame:
    """``key``, ``other`` and ``id`` of all pairs that may be a best match of ``least`` or more; all
    ties are among them.

    Both sides come from ``measured``; ``asked`` has non-empty keys, ``offered`` each key once.
    """
    near, far = _near_and_far(asked, offered, least)
    sizes = _class_sizes(offered)
    raised = materialize(_raised(far, offered, sizes))
    pairs = _by_length(raised, offered, sizes).select(*_pair())
    return pairs if near.isEmpty() else _by_pieces(near, offered).unionByName(pairs)


def _best_in_cell(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
    """The best item of a cell for each name that asks there, where it reaches the name's floor."""
    if not len(asked) or not len(offered):
        return pd.DataFrame([], columns=["key", "score", "id"])
    # Items in id order, so that the first of equal scores has the lowest id.
    offered = offered.sort_values("id", kind="stable", na_position="last")
    floor = asked["floor"].to_numpy(np.int64)
    score, place = best_ratios(asked["key"].tolist(), offered["key"].tolist(), floor)
    some = np.flatnonzero((score > 0) & (score >= floor))
    keys, ids = asked["key"].to_numpy(object)[some], offered["id"].to_numpy(object)[place[some]]
    columns = {"key": pd.Series(keys, dtype=object), "score": score[some]}
    return pd.DataFrame(columns | {"id": pd.Series(ids, dtype=object)})


def _drawn(rows: DataFrame, number: int, of: int) -> DataFrame:
    """About ``number`` of the ``of`` rows, by the hash of their key."""
    share = max(1, of // max(number, 1))
    return rows.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(share)) == 0)


def _cuts(keys: list[str], parts: int) -> list[str]:
    """Where to cut so that drawn keys fall into ``parts`` of about equal number."""
    keys = sorted(keys, key=str.encode)
    return [keys[len(keys) * i // parts] for i in range(1, parts)] if keys else []


def _slot(cuts: str) -> Column:
    return F.size(F.filter(cuts, lambda cut: cut <= F.col("key")))


def _whole_blocks(asked: DataFrame, offered: DataFrame, tasks: int) -> DataFrame:
    """For each class of lengths how many ``blocks`` its items make, and into how many ``parts`` the
    names that ask are dealt so that there are cells for all ``tasks``.

    Names that lie side by side come into one block, and into one part, by ``cuts`` from a sample: they
    begin alike, so that more is compared once.  The result does not depend on the cuts.
    """
    counts = offered.groupBy(_class(F.col("length")).alias("class")).count().collect()
    blocks = {}
    for row in counts:
        rows = min(WHOLE_ROWS, max(1, int(WHOLE_LETTERS / 2 ** ((row["class"] + 1) / 4))))
        blocks[row["class"]] = -(-row["count"] // rows)
    number = asked.count()
    most = max(blocks.values(), default=1)
    parts = max(-(-number // ASKED_ROWS), min(-(-tasks // most), -(-number // 64)), 1)
    # CUT_SAMPLE keys for each block and part, about.
    total = sum(row["count"] for row in counts)
    drawn = _drawn(offered, CUT_SAMPLE * sum(blocks.values()), total) if most > 1 else offered.limit(0)
    keys: dict[int, list[str]] = {}
    for row in drawn.select(_class(F.col("length")).alias("class"), "key").collect():
        keys.setdefault(row["class"], []).append(row["key"])
    asking = _drawn(asked, CUT_SAMPLE * parts, number) if parts > 1 else asked.limit(0)
    among = _cuts([row["key"] for row in asking.select("key").collect()], parts)
    kinds = "class int, blocks int, parts int, item_cuts array<string>, asked_cuts array<string>"
    rows = [(name, many, parts, _cuts(keys.get(name, []), many), among) for name, many in blocks.items()]
    return offered.sparkSession.createDataFrame(rows, kinds)


def _met_whole(asked: DataFrame, offered: DataFrame) -> DataFrame:
    """``key``, ``score`` and ``id``: the best of each cell that a name's floor lets it meet.

    Names that are like none by pieces meet all of a fitting length, block against block; a block's
    equal beginnings and endings are compared once, so no pair ever is a row.
    """
    spark = asked.sparkSession
    tasks = 4 * spark.sparkContext.defaultParallelism
    sizes = F.broadcast(_whole_blocks(asked, offered, tasks))
    length, score = F.col("length"), F.col("floor")
    classes = F.sequence(
        _class(F.greatest(_shortest(length, score), F.lit(1))), _class(_longest(length, score))
    )
    probes = asked.select("key", "floor", F.explode(classes).alias("class")).join(sizes, "class")
    probes = probes.withColumn("part", _slot("asked_cuts"))
    probes = probes.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    probes = probes.select("key", "floor", "class", "block", "part")
    rows = offered.select("key", "id", _class(length).alias("class")).join(sizes, "class")
    rows = rows.withColumn("block", _slot("item_cuts"))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("key", "id", "class", "block", "part")
    cell = ["class", "block", "part"]
    # An explicit count: the cells are small in bytes but long to work on.
    left, right = (side.repartition(4 * tasks, *cell).groupBy(*cell) for side in (probes, rows))
    ids = offered.schema["id"].dataType.simpleString()
    return left.cogroup(right).applyInPandas(_best_in_cell, f"key string, score int, id {ids}")


def _best_by_length(asked: DataFrame, offered: DataFrame) -> DataFrame:
    """``key``, ``score`` and ``id``: the best of each cell that a name's floor lets it meet.

    Where there are many items, a few of them, drawn by hash, are met first, then more: the best score
    with these raises the floor, so that most beginnings of names need not be followed to their end.
    """
    number, drawn = offered.count(), DRAWN_ROWS
    while number > 4 * drawn:
        first = _met_whole(asked, _drawn(offered, drawn, number))
        told = first.groupBy("key").agg(F.max("score").alias("reached"))
        raised = F.greatest("floor", "reached").alias("floor")
        others = [c for c in asked.columns if c != "floor"]
        asked = materialize(asked.join(told, "key", "left").select(*others, raised))
        drawn *= 8
    return _met_whole(asked, offered)


def _best_of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The scores of pairs, of which each batch passes on the best of each name."""
    for pairs in batches:
        pairs["score"] = ratio_pairs(pairs["key"].tolist(), pairs["other"].tolist())
        best = pairs["score"] == pairs.groupby("key")["score"].transform("max")
        kept = pairs[best & (pairs["score"] > 0)]
        yield kept.groupby("key", as_index=False).agg({"score": "first", "id": "min"})


def best_names(queries: DataFrame, items: DataFrame, least: int = 1) -> DataFrame:
    """For each name key the most similar item: columns ``key``, ``score`` (``least`` to 100), ``id``.

    ``queries`` has column ``key`` and ``items`` columns ``key`` and ``id``; keys come from
    ``functions.text.token_sort_key``.  Among equal scores the lowest id wins; a query with no
    such similarity to any item has no row, and the higher ``least``, the fewer pairs are looked at.
    Nothing is capped: pairs are left out only where their
    lengths, pieces or letters show that they score less than a pair already known.
    """
    # Small in bytes but long to measure: an explicit count keeps them from being merged by size.
    tasks = 4 * queries.sparkSession.sparkContext.defaultParallelism
    offered = items.groupBy("key").agg(F.min("id").alias("id")).repartition(tasks, "key")
    offered = materialize(measured(offered))
    asked = queries.select("key").distinct().repartition(tasks, "key").join(
        offered.select("key", F.col("id").alias("same")), "key", "left"
    )
    asked = materialize(measured(asked))
    # Only an equal key scores 100 here, so no other item can do as well; and an empty key is equal
    # to an empty key and unlike every other.
    alone = F.col("length") * 2 + 1 < _ROUNDS_TO_EQUAL
    settled = asked.where(F.col("same").isNotNull() & alone)
    settled = settled.select("key", F.lit(100).alias("score"), F.col("same").alias("id"))
    still = asked.where((F.col("same").isNull() | ~alone) & (F.col("length") > 0)).drop("same")
    near, far = _near_and_far(still, offered.where("length > 0"), least)
    scored = _best_by_length(far, offered.where("length > 0"))
    if not near.isEmpty():
        ids = items.schema["id"].dataType.simpleString()
        pairs = _by_pieces(near, offered.where("length > 0"))
        by_pieces = pairs.mapInPandas(_best_of_batches, f"key string, score int, id {ids}")
        scored = scored.unionByName(by_pieces)
    order = F.struct(-F.col("score"), F.col("id"))
    best = scored.where(F.col("score") >= least).groupBy("key").agg(F.min_by(F.struct("score", "id"), order).alias("best"))
    # Written out, so that no later step scores the pairs again.
    return materialize(settled.unionByName(best.select("key", "best.score", "best.id")))
