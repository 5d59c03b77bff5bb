"""The staging table: raw client records as they came in, one folder per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat import schemas as S

_SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STAGED) + ", run_id string"

# Share of the rows by which the time read from a sketch may lie off.
SKETCH_ERROR = 0.03


def stage(clients: DataFrame, root: str, run_id: str, ingested_at: Column) -> None:
    """Append a run's records.  Staging the same run again replaces its own rows only."""
    rows = clients.select(
        *S.CLIENT_COLUMNS,
        ingested_at.cast("timestamp").alias("ingested_at"),
        F.lit(run_id).alias("run_id"),
    )
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id").parquet(root)


def read_staged(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(root)


def _cut(staged: DataFrame, limit: int) -> Column | None:
    """A time from which on there are ``limit`` rows or more, and few more than that.

    Each round merges one sketch of the times from the tasks and reads from it a time a little
    further back than the limit; the rows from then on are counted, so the result does not depend
    on what the sketch gets wrong, and sketched again while they are many.
    """
    time = F.unix_micros("ingested_at")
    oldest, rows = None, staged.where(F.col("ingested_at").isNotNull())
    while True:
        told = rows.agg(F.count("*").alias("n"), F.kll_sketch_agg_bigint(time).alias("times"))
        told = told.first()  # a number and a sketch of a few kilobytes
        if told.n <= 2 * limit:
            break
        reach = F.lit(max(0.0, 1 - limit / told.n - SKETCH_ERROR))
        read = F.kll_sketch_get_quantile_bigint(F.lit(bytes(told.times)), reach)
        cut = staged.sparkSession.range(1).select(read).first()[0]
        newer = rows.where(F.col("ingested_at") >= F.timestamp_micros(F.lit(cut)))
        if cut == oldest or newer.count() < limit:
            break
        oldest, rows = cut, newer
    return None if oldest is None else F.timestamp_micros(F.lit(oldest))


def latest_staged(staged: DataFrame, limit: int = S.STAGED_LIMIT) -> DataFrame:
    """The newest staged records, ties by client id; rows without a time come last.

    A sketch of the ingestion times tells how far back the limit reaches, whether a run has one
    time or every row its own; only rows from then on are sorted.
    """
    oldest = _cut(staged, limit)
    recent = staged if oldest is None else staged.where(F.col("ingested_at") >= oldest)
    newest = recent.orderBy(F.desc("ingested_at"), "client_id").limit(limit)
    return newest.select(*S.CLIENT_COLUMNS, "ingested_at")


def clear(spark: SparkSession, root: str) -> None:
    """Leave an empty staging table behind."""
    empty = spark.createDataFrame([], S.STAGED).withColumn("run_id", F.lit(""))
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(root)
