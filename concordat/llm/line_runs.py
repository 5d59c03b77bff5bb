"""Repeated runs of lines by an index of all windows.

Of the hashes of every ``window`` successive lines the smallest is a fingerprint; it only filters
out the windows whose fingerprint has one place.  All others meet on the hashes of all their lines,
and matching windows chain to runs, instead of an extension line by line from a few selected
fingerprints as in winnowing.  All but the first copy of a run goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.common import text_or_empty

# Lines that a run has at least.
WINDOW = 3
CUTS = "array<struct<start:int,lines:array<bigint>>>"


def _windows(docs: DataFrame, window: int, words: int | None) -> DataFrame:
    """Each window of lines under the fingerprint that it selects, with its lines' hashes."""
    lines = F.split(F.col("body"), "\n", -1)
    hashed = docs.select(
        "doc_id",
        "body_hash",
        F.transform(lines, lambda line: F.xxhash64(line)).alias("hashes"),
        F.transform(lines, lambda line: F.regexp_count(line, F.lit(r"\S+"))).alias("counts"),
    )

    def cut(size: int) -> Column:
        """The windows of ``size`` lines; those below ``window`` lines need the words."""
        starts = F.sequence(F.lit(0), F.size("hashes") - size)
        if size < window:
            starts = F.filter(
                starts,
                lambda s: sum((F.get("counts", s + i) for i in range(size)), F.lit(0)) > words,
            )
        cuts = F.transform(
            starts, lambda s: F.struct(s.alias("start"), F.slice("hashes", s + 1, size).alias("lines"))
        )
        return F.when(F.size("hashes") >= size, cuts).otherwise(F.array().cast(CUTS))

    sizes = [window] if words is None else range(1, window + 1)
    each = hashed.select(
        "doc_id", "body_hash", F.explode(F.concat(*map(cut, sizes))).alias("cut")
    ).select("doc_id", "body_hash", "cut.start", "cut.lines")
    lowest = F.array_min("lines")
    spot = F.col("start") + F.array_position("lines", lowest) - 1
    return each.withColumn("fingerprint", lowest).withColumn("spot", spot)


def repeated_runs(docs: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """The runs to delete: ``doc_id``, ``body_hash`` and the run's first and past-the-end line.

    ``docs`` has ``doc_id``, ``body`` and ``body_hash``.  A run is a chain of matching windows.  Each
    window meets the first place with its fingerprint and lines, never every other place, so a
    passage with very many copies costs one row a copy.
    """
    windows = _windows(docs, window, words)
    place = F.struct("doc_id", "body_hash", "start")
    # Fingerprints with one place cannot match.  Both joins use another key than the groups that
    # they meet, so both of their sides are shuffled and a hot key can be split.
    spot = F.struct("doc_id", "body_hash", "spot")
    seen = (
        windows.groupBy("fingerprint")
        .agg(F.min(spot).alias("first"), F.max(spot).alias("last"))
        .where("first < last")
        .select(F.xxhash64("fingerprint").alias("meeting"))
    )
    met = windows.withColumn("meeting", F.xxhash64("fingerprint")).join(seen, "meeting")
    met = met.select("doc_id", "body_hash", "start", F.xxhash64("lines").alias("key"), "lines")
    firsts = (
        met.groupBy("key", "lines")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("key", F.col("lines").alias("first_lines"), "first")
    )
    later = (
        met.join(firsts, "key")
        .where(F.col("lines") == F.col("first_lines"))
        .where(place > F.col("first"))
        .select("doc_id", "body_hash", "start", (F.col("start") + F.size("lines")).alias("past"))
        .groupBy("doc_id", "body_hash", "start")
        .agg(F.max("past").alias("past"))
    )
    inside = Window.partitionBy("doc_id", "body_hash").orderBy("start")
    before = F.max("past").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > before, F.lit(True))
    return (
        later.withColumn("opens", opens.cast("int"))
        .withColumn("run", F.sum("opens").over(inside))
        .groupBy("doc_id", "body_hash", "run")
        .agg(F.min("start").alias("first"), F.max("past").alias("past"))
        .drop("run")
    )


def drop_repeated_runs(
    docs: DataFrame, window: int = WINDOW, words: int | None = None
) -> DataFrame:
    """``docs`` with ``text`` without its repeated runs, and ``n_lines``, ``n_removed``, ``n_runs``.

    Lines end at line feeds and are compared as they are.  A line goes if it lies in ``window``
    successive lines that also start earlier, in an earlier document (smaller id; a missing id
    first) or further up in the same one; runs are judged on the input.  Texts with fewer lines
    stay, unless ``words`` is given: then fewer lines qualify too if they have more than so many
    words (strings without ASCII white space) together.  A missing text counts as one empty line and stays missing.  Rows that repeat both id and
    text are one document and share one verdict.  Other columns pass through whatever their names;
    only ``n_lines``, ``n_removed`` and ``n_runs`` are replaced if present.
    """
    kept = [name for name in docs.columns if name not in ("n_lines", "n_removed", "n_runs")]
    rows = docs.select(F.struct(*kept).alias("row"), "doc_id", text_or_empty().alias("body"))
    rows = rows.withColumn("body_hash", F.xxhash64("body"))
    runs = repeated_runs(rows, window, words)
    run = F.struct(F.col("first"), F.col("past"))
    found = runs.groupBy("doc_id", "body_hash").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    found = found.select(F.col("doc_id").alias("run_id"), F.col("body_hash").alias("run_hash"), "runs")
    joined = rows.join(
        found,
        F.col("doc_id").eqNullSafe(F.col("run_id")) & (F.col("body_hash") == F.col("run_hash")),
        "left",
    )
    lines = F.split(F.col("body"), "\n", -1)
    none = F.array().cast("array<int>")
    firsts = F.coalesce(F.col("runs.first"), none)
    pasts = F.coalesce(F.col("runs.past"), none)
    held = F.zip_with(
        F.concat(F.array(F.lit(0)), pasts),
        F.concat(firsts, F.array(F.size(lines))),
        lambda a, b: F.slice("lines", a + 1, F.greatest(b - a, F.lit(0))),
    )
    joined = joined.withColumn("lines", lines)
    removed = F.aggregate(
        F.coalesce("runs", F.array().cast("array<struct<first:int,past:int>>")),
        F.lit(0),
        lambda total, r: total + r["past"] - r["first"],
    )
    text = F.when(F.col("runs").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.flatten(held), "\n")
    )
    return joined.select(
        *[text.alias(name) if name == "text" else F.col(f"row.`{name}`") for name in kept],
        F.size(lines).alias("n_lines"),
        removed.alias("n_removed"),
        F.size(firsts).alias("n_runs"),
    )
