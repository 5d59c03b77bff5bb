"""Secrets in texts, told from copied examples by who holds them across the whole corpus."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import staged, text_or_empty
from concordat.operators.skew import lookup_join

# The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

# A bare token is hashed from this length on; on its own looks it needs more.
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
LOOKS_LEAST = 20
LOOKS_DISTINCT = 10

_HEX_RUN = re.compile(f"[0-9a-f]{{{HEX_LEAST},}}")  # the same as long enough runs of HEX
_DIGIT = re.compile("[0-9]")
_FOUND = "array<struct<start: int, kind: int, stop: int, value: string, looks: boolean>>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` of every base match that is long enough, by start, then kind."""
    found = []
    if "=" in text or ":" in text:
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= ASSIGN_LEAST:
                found.append((match.start(), 0, match.end(), match[2]))
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if len(match[0]) >= ACCESS_LEAST:
                found.append((match.start(), 1, match.end(), match[0]))
    for match in _HEX_RUN.finditer(text):
        found.append((match.start(), 2, match.end(), match[0]))
    return sorted(found)


def looks_live(token: str) -> bool:
    """Long, of many different characters, with digits and letters of both cases."""
    return (
        len(token) >= LOOKS_LEAST
        and len(set(token)) >= LOOKS_DISTINCT
        and any(c.isdigit() for c in token)
        and any(c.isupper() for c in token)
        and any(c.islower() for c in token)
    )


def bare_tokens(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Tokens with a digit and a letter that no base span touches."""
    if not _DIGIT.search(text):
        return []
    found, at, reach = [], 0, 0
    for match in TOKEN.finditer(text):
        start, end = match.span()
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        token = match[0]
        if reach <= start and _DIGIT.search(token) and any(c.isalpha() for c in token):
            found.append((start, 3, end, token))
    return found


def _digest(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()[:32]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct(
            [
                ("start", pa.int32()),
                ("kind", pa.int32()),
                ("stop", pa.int32()),
                ("value", pa.string()),
                ("looks", pa.bool_()),
            ]
        )
    )
    for batch in batches:
        rows = []
        for text in batch.column(batch.num_columns - 1):
            base = base_spans(text := text.as_py())
            spans = base + bare_tokens(text, base)
            rows.append([(a, k, b, _digest(v), k == 3 and looks_live(v)) for a, k, b, v in spans])
        columns = [*batch.columns[:-1], pa.array(rows, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "found"])


def scan_secrets(docs: DataFrame, repo: Column, owner: Column) -> DataFrame:
    """For each row ``doc_id``, ``repo``, ``owner``, a row number and all it may hold, as hashes.

    Written once, so that row numbers stay and texts are not read again.
    """
    texts = docs.select("doc_id", repo.alias("repo"), owner.alias("owner"), text_or_empty().alias("text"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema[:3])
    scanned = texts.mapInArrow(_scan, f"{kept}, found {_FOUND}")
    return staged(scanned.withColumn("row", F.monotonically_increasing_id()), "secrets")


def value_owners(scanned: DataFrame, wide: int = 2) -> DataFrame:
    """Each hashed value with its number of owners, repositories and places, and a verdict.

    ``example`` stands with ``wide`` owners or more; ``live`` with fewer, if the value stands in a
    base span anywhere or looks like a credential; ``plain`` else.  A missing owner or repository
    counts as one.  The counts combine on the map side, first by repository, then by owner, so a
    value that is everywhere is one row for each task.
    """
    held = scanned.select("repo", "owner", F.explode("found").alias("f"))
    marks = F.max(F.col("f.kind") < 3).alias("base"), F.max("f.looks").alias("looks")
    more = F.max("base").alias("base"), F.max("looks").alias("looks")
    by_repo = held.groupBy(F.col("f.value").alias("value"), "owner", "repo").agg(
        F.count("*").alias("places"), *marks
    )
    by_owner = by_repo.groupBy("value", "owner").agg(
        F.count("*").alias("repos"), F.sum("places").alias("places"), *more
    )
    whole = by_owner.groupBy("value").agg(
        F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum("places").alias("places"), *more
    )
    verdict = (
        F.when(F.col("owners") >= wide, "example")
        .when(F.col("base") | F.col("looks"), "live")
        .otherwise("plain")
    )
    return whole.withColumn("verdict", verdict)


def _told(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


def find_secrets(docs: DataFrame, repo: Column, owner: Column, wide: int = 2) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with the secrets in its whole text.

    Base spans are assignments, access keys and long hex runs, leftmost and without overlaps for
    each kind; they always stay.  Their values, and other tokens of twelve characters or more with
    a digit and a letter, are hashed and counted over the corpus by distinct owners and
    repositories.  A bare token outside the base spans becomes a span of kind ``owned`` when fewer
    than ``wide`` owners hold it and it either is the value of a base span somewhere or looks like a
    credential; what several owners hold is a copied example and is not added.

    Gives ``doc_id``, the numbers of base spans, ``base_sha256`` and ``spans``
    (``kind:start:end`` in code points, by start, then kind), and in ``n_live`` and ``n_example``
    how many of the row's spans hold a value of one owner or of several.  A missing text is empty; a
    missing owner or repository is one of its own; repeated rows, ids that repeat or are missing and
    texts of any length are all judged row by row; further columns are ignored; an empty table gives
    no rows.
    """
    scanned = scan_secrets(docs, repo, owner)
    verdicts = value_owners(scanned, wide).where("verdict <> 'plain'").select("value", "verdict")
    verdicts = staged(verdicts, "secrets")
    held = scanned.select("row", F.explode("found").alias("f")).select(
        "row", F.struct("f.start", "f.kind", "f.stop").alias("span"), F.col("f.value").alias("value")
    )
    judged = lookup_join(held, verdicts, "value", "inner")
    added = (F.col("span.kind") == 3) & (F.col("verdict") == "live")
    counted = (F.col("span.kind") < 3) | added
    marks = judged.groupBy("row").agg(
        F.collect_list(F.when(added, F.col("span"))).alias("added"),
        F.count_if(counted & (F.col("verdict") == "live")).alias("n_live"),
        F.count_if(counted & (F.col("verdict") == "example")).alias("n_example"),
    )
    base = F.transform(
        F.filter("found", lambda s: s["kind"] < 3),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")),
    )
    kinds = F.transform("base", lambda s: s["kind"])
    many = [
        F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{name}")
        for k, name in enumerate(KINDS[:3])
    ]
    none = F.lit(0).cast("long")
    return scanned.withColumn("base", base).join(marks, "row", "left").select(
        "doc_id",
        *many,
        F.sha2(_told("base"), 256).alias("base_sha256"),
        _told(F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))).alias(
            "spans"
        ),
        F.coalesce("n_live", none).alias("n_live"),
        F.coalesce("n_example", none).alias("n_example"),
    )
