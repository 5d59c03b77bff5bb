"""What the text operators share: table access, staged tables and sampled range cuts."""

from __future__ import annotations

import ctypes
import json
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.session import run_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Whether Spark deletes a query's shuffle files at its end, rather than when the driver happens to
# collect the query as garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Where the tables lie that ``staged`` has written.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@contextmanager
def _cleaned_up(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; later plans start from the copy, so
    what was shuffled for it goes at once."""
    path = run_folder(df.sparkSession, purpose)
    with _cleaned_up(df.sparkSession):
        df.write.parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[copy] = path
    return copy


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``staged`` has written and that no later plan reads."""
    for table_ in tables:
        jvm, conf = table_.sparkSession._jvm, table_.sparkSession._jsparkSession.sessionState().newHadoopConf()
        folder = jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(table_))
        folder.getFileSystem(conf).delete(folder, True)


Batches = Iterator[pa.RecordBatch]

# Caches that tasks of one kind keep for each other in their worker.
_CACHES: list[Callable] = []


def for_own_tasks(cached: Callable) -> Callable:
    """A function with an ``lru_cache``, which tasks that have no use for it empty."""
    _CACHES.append(cached)
    return cached


def release(using: Callable | None = None) -> None:
    """Give unused memory back to the system, and what caches other than ``using`` hold.

    Workers outlive their tasks and an executor has several of them, so what each one keeps counts
    until the job's end.
    """
    for cached in _CACHES:
        if cached is not using:
            cached.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def releasing(
    run: Callable[[Batches], Batches], using: Callable | None = None
) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, with a ``release`` before and after each task."""

    def released(batches: Batches) -> Batches:
        release(using)
        yield from run(batches)
        release(using)

    return released


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sampled_cuts(keys: DataFrame, parts: int, per_part: int = 64) -> list:
    """About ``parts - 1`` sorted cut values of the one column of ``keys``, from a sample.

    The sample holds about ``per_part`` rows for each part, whatever the size of the table, so it
    fits the driver.  A value that fills several parts appears that often among the cuts.  Results
    never depend on the cuts, only the balance of the work does.
    """
    rows = keys.count()
    if rows == 0 or parts < 2:
        return []
    share = parts * per_part / rows
    drawn = keys if share >= 1 else keys.sample(share, seed=7)
    values = sorted(row[0] for row in drawn.collect())
    if not values:
        return []
    return [values[len(values) * i // parts] for i in range(1, parts)]


def below(key: Column, cuts: list, inclusive: bool, kind: str = "string") -> Column:
    """How many cuts lie below ``key`` (or at it), found in two steps of about a square root."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    chunks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    heads = F.from_json(F.lit(json.dumps([c[-1] for c in chunks])), f"array<{kind}>")
    body = F.from_json(F.lit(json.dumps(chunks)), f"array<array<{kind}>>")

    def passed(cut: Column) -> Column:
        return cut <= key if inclusive else cut < key

    whole = F.size(F.filter(heads, passed))
    rest = F.coalesce(F.size(F.filter(F.get(body, whole), passed)), F.lit(0))
    return (whole * step + F.greatest(rest, F.lit(0))).cast("int")


def range_slot(key: Column, cuts: list[str], spread: Column) -> Column:
    """The part of ``key`` among the cuts; a value that several cuts name is dealt over its parts
    by the hash of ``spread``."""
    low, high = below(key, cuts, False), below(key, cuts, True)
    return (low + F.pmod(F.xxhash64(spread), high - low + 1)).cast("int")


def first_slot(key: Column, cuts: list[str]) -> Column:
    """The lowest part that rows with ``key`` can be in."""
    return below(key, cuts, False)
