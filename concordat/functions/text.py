"""Text expressions: normalising names and comparing them."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions.lcs import ratio_pairs

# The characters Unicode counts as white space, and the name-cleaning patterns.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LATIN1_SUPPLEMENT = r"[\x{80}-\x{FF}]"
NOT_WORD = r"[^\p{L}\p{N}_]+"
# End of fixed values.


def present(column: Column) -> Column:
    """Neither null nor empty; a blank string is present."""
    return F.coalesce(column != "", F.lit(False))


def normalized(column: Column) -> Column:
    """Null becomes empty; white space is cut from both ends; lower case."""
    return F.lower(F.btrim(F.coalesce(column, F.lit("")), F.lit(WHITESPACE)))


def shown(column: Column) -> Column:
    """The value as an issue text prints it."""
    return F.coalesce(column, F.lit("None"))


def token_sort_key(column: Column) -> Column:
    """Lower-cased word tokens in code-point order, joined by single blanks.

    Two names with equal keys are the same words in any order, case and punctuation.
    """
    lowered = F.lower(F.coalesce(column, F.lit("")))
    ascii_only = F.octet_length(lowered) == F.length(lowered)
    kept = F.when(ascii_only, lowered).otherwise(
        F.regexp_replace(lowered, LATIN1_SUPPLEMENT, "")
    )
    words = F.split(F.trim(F.regexp_replace(kept, NOT_WORD, " ")), " ")
    return F.array_join(F.sort_array(words), " ")


# Letters of one name in one whole number: sums of two such numbers stay below 63 bits.
_WORD_BITS = 60
_FULL = (1 << _WORD_BITS) - 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, not at every mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _places(letters: Column, letter: Column) -> Column:
    """The places at which ``letter`` stands among up to 60 ``letters``, as bits."""
    none = F.lit(0).cast("long")
    bits = F.transform(
        letters,
        lambda c, i: F.when(
            c == letter, F.call_function("shiftleft", F.lit(1).cast("long"), i)
        ).otherwise(none),
    )
    return F.aggregate(bits, none, lambda all_, bit: all_.bitwiseOR(bit))


def _table(letters: Column, places: Callable[[Column], Column]) -> Column:
    entry = lambda c: F.struct(c, places(c))
    return F.map_from_entries(F.transform(F.array_distinct(letters), entry))


def _common_short(letters: Column, other: Column) -> Column:
    """The recurrence where the letters fit one number."""
    none = F.lit(0).cast("long")

    def step(row: Column, match: Column) -> Column:
        both = row.bitwiseAND(match)
        return (row + both).bitwiseAND(F.lit(_FULL)).bitwiseOR(row - both)

    def last(table: Column) -> Column:
        matches = F.transform(other, lambda c: F.coalesce(F.try_element_at(table, c), none))
        return F.aggregate(matches, F.lit(_FULL), step)

    row = _let(_table(letters, lambda c: _places(letters, c)), last)
    return F.lit(_WORD_BITS) - F.bit_count(row)


def _stepped(row: Column, matches: Column) -> Column:
    """One letter of the bit-vector recurrence of Hyyro (2004), carried from word to word."""

    def word(state: Column, pair: Column) -> Column:
        both = pair["row"].bitwiseAND(pair["match"])
        total = pair["row"] + both + state["carry"]
        out = total.bitwiseAND(F.lit(_FULL)).bitwiseOR(pair["row"] - both)
        return F.struct(
            F.concat(state["row"], F.array(out)).alias("row"),
            F.call_function("shiftright", total, F.lit(_WORD_BITS)).alias("carry"),
        )

    pairs = F.zip_with(row, matches, lambda r, m: F.struct(r.alias("row"), m.alias("match")))
    start = F.struct(
        F.array().cast("array<bigint>").alias("row"), F.lit(0).cast("bigint").alias("carry")
    )
    return F.aggregate(pairs, start, word, lambda state: state["row"])


def _common_long(letters: Column, other: Column) -> Column:
    """The recurrence where the letters take several numbers."""
    words = F.sequence(F.lit(0), F.floor((F.size(letters) - 1) / _WORD_BITS).cast("int"))

    def places(letter: Column) -> Column:
        part = lambda w: F.slice(letters, w * _WORD_BITS + 1, F.lit(_WORD_BITS))
        return F.transform(words, lambda w: _places(part(w), letter))

    def last(table: Column) -> Column:
        full = F.transform(words, lambda _: F.lit(_FULL))
        none = F.transform(words, lambda _: F.lit(0).cast("long"))
        matches = F.transform(other, lambda c: F.coalesce(F.try_element_at(table, c), none))
        return F.aggregate(matches, full, _stepped)

    row = _let(_table(letters, places), last)
    ones = F.aggregate(row, F.lit(0), lambda n, word: n + F.bit_count(word))
    return F.size(row) * _WORD_BITS - ones


def common_letters(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts of any length, as an expression.

    A row of the table of lengths is held as bits, one for each letter of ``a``: zero where the
    length grows by one.
    """

    def common(pair: Column) -> Column:
        short = F.size(pair["a"]) <= _WORD_BITS
        return F.when(short, _common_short(pair["a"], pair["b"])).otherwise(
            _common_long(pair["a"], pair["b"])
        )

    return _let(F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b")), common)


@F.pandas_udf(T.IntegerType())
def _ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(ratio_pairs(left.tolist(), right.tolist()))


def key_ratio(a: Column, b: Column) -> Column:
    """``token_sort_ratio`` of two names that are already keys, for very many pairs: in batches
    outside the JVM, several times as fast."""
    return _ratio(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity of two names from 0 to 100, blind to word order, case and punctuation.

    Twice the longest common subsequence of the two keys over their joint length, in whole
    percent; equal keys give 100, and one empty key gives 0.
    """
    keys = F.struct(token_sort_key(a).alias("a"), token_sort_key(b).alias("b"))

    def ratio(pair: Column) -> Column:
        # The shorter one gives the bits.
        swap = F.length(pair["a"]) > F.length(pair["b"])
        short, long = (F.when(swap, pair[x]).otherwise(pair[y]) for x, y in ("ba", "ab"))
        total = F.length(short) + F.length(long)
        share = F.lit(1.0) - (total - common_letters(short, long) * 2) / total
        return (
            F.when(short == long, 100)
            .when(short == "", 0)
            .otherwise(F.rint(share * 100.0).cast("int"))
        )

    return _let(keys, ratio)
