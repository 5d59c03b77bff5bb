"""Allow and block rules for urls by a sorted sweep.

Reversed hosts turn "this host and all below it" into a prefix, and a prefix into an interval of
sorted keys.  Pages and rules are put in one sorted order; each page takes up the stack of nested
rules that was opened last before it.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.common import first_slot, partitions, range_slot, sampled_cuts

# Parts for each shuffle partition.
PARTS = 4
# Longest text kept of a cut value.
CUT_LENGTH = 1000
# Between host and path in a key: sorts below whatever hosts and paths are made of.
_END = "\x01"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit(_END), path)


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule's key with the stack of rules of its host whose path is a prefix of its own."""
    parts = rules.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("block"))
    named = parts.select(
        "host", "path", F.when(F.col("block"), "block").otherwise("allow").alias("verdict")
    )
    cut = F.explode(F.sequence(F.lit(0), F.length("path")))
    prefixes = named.select("host", F.col("path").alias("own"), cut.alias("cut")).select(
        "host", "own", F.expr("substring(own, 1, cut)").alias("path")
    )
    entry = F.struct("host", "path", "verdict")
    return (
        prefixes.join(named, ["host", "path"])
        .groupBy("host", "own")
        .agg(F.collect_list(entry).alias("stack"))
        .select(_key(F.split("host", r"\."), F.col("own")).alias("key"), "stack")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row for each row of ``pages`` (``page_id``, ``url``) with the rule that decides it.

    ``rules`` has ``host``, ``path`` and ``verdict``.  A rule fits its host and all subdomains where
    the page's path starts with the rule's; the longest rule wins, of equally long ones that with
    the longer host.  A rule given with both verdicts blocks.  Pages that no rule fits get a null
    rule and the ``default`` verdict, among them those with a missing url or one without ``://``,
    whose host and path are empty.  Repeated rows stay repeated; empty tables of pages or rules are
    allowed.

    A page meets the rules of its own host and of each parent host that a rule can name, each as one
    row of the sweep.  Cuts sampled from the pages divide the sorted order; every part starts with
    the stack that was open at its first key, found from the parts' last rules.
    """
    spark = pages.sparkSession
    parts = partitions(spark)
    rules = rules.where(F.col("host").isNotNull()).select(
        "host", F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    stacks = _stacks(rules)
    # No parent host with more labels than any rule's host can meet a rule.
    depth = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    labels = F.split("host", r"\.")
    heights = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth)))
    own = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    met = own.withColumn("height", F.explode(heights)).withColumn(
        "above", F.expr("slice(split(host, '[.]'), -height, height)")
    )
    keyed = met.select(
        "page_id", "host", "path", "height",
        F.array_join("above", ".").alias("above"),
        _key(F.col("above"), F.col("path")).alias("key"),
    )
    cuts = sampled_cuts(keyed.select(F.substring("key", 1, CUT_LENGTH)), PARTS * parts)
    rows = keyed.withColumn("part", range_slot(F.col("key"), cuts, F.col("page_id")))
    opened = stacks.withColumn("part", first_slot(F.col("key"), cuts))
    # The rule opened last before a part begins: one row a part.
    last = opened.groupBy("part").agg(F.max("key").alias("key"))
    every = spark.range(len(cuts) + 1).select(F.col("id").cast("int").alias("part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(last, "part", "left").select("part", F.max("key").over(before).alias("key"))
    carries = carried.join(stacks, "key").select("part", F.lit("").alias("key"), "stack")
    opens = carries.unionByName(opened).withColumn("kind", F.lit(0))
    order = Window.partitionBy("part").orderBy("key", "kind")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = (
        rows.withColumn("kind", F.lit(1))
        .unionByName(opens, allowMissingColumns=True)
        .repartition(parts, "part")
        .withColumn("open", F.last("stack", ignorenulls=True).over(upto))
        .where("kind = 1")
    )
    page_path = F.col("path")
    fitting = F.filter(
        "open", lambda r: (r["host"] == F.col("above")) & F.startswith(page_path, r["path"])
    )
    ranked = F.transform(
        fitting,
        lambda r: F.struct(
            (F.length(r["host"]) + F.length(r["path"])).alias("size"),
            F.length(r["host"]).alias("host_size"),
            F.concat(r["host"], r["path"]).alias("rule"),
            r["verdict"].alias("verdict"),
        ),
    )
    judged = (
        swept.withColumn("best", F.array_max(ranked))
        .groupBy("page_id", "host", "path")
        .agg(F.max("best").alias("best"), F.count_if(F.col("height") == 1).alias("copies"))
    )
    return judged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
