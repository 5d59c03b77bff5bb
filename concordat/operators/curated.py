"""The curated table: keyed merges into plain partitioned Parquet, and reads over it.

Rows lie in ``data/bucket=B``, the bucket being a hash of the client id.  A merge reads the buckets
its rows fall into, keeps what is newer there and overwrites just these partitions; then it writes
their totals anew, from which reports and the status mart are merged without reading a row.  A merge
that fails before its commit leaves the table as it was; one that is cut off while its partitions are
moved into place is put right by merging the same batch again.  One merge runs at a time, and reads
that run beside it may have to be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat import schemas as S
from concordat.operators.dedupe import last_wins
from concordat.operators.quality import history_row, mart_of, partials, report_of
from concordat.operators.skew import lookup_join
from concordat.session import materialize

# Buckets whose totals, a row for each country and status, are read by one task.
FEW_BUCKETS = 64

_STORED = T.StructType(
    [
        *S.CURATED.fields,
        T.StructField("ordered_at", T.TimestampType()),
        T.StructField("tie", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)


def issues_json(issues: Column) -> Column:
    """The issue list as a JSON array."""
    return F.to_json(issues)


def top_entities(
    curated: DataFrame, limit: int = S.LISTING_LIMIT, status: str | None = None
) -> DataFrame:
    """Best scores first, ties by client id, optionally of one status only."""
    rows = curated if status is None else curated.where(F.col("verification_status") == status)
    return rows.orderBy(F.desc("quality_score"), "client_id").limit(limit)


class CuratedStore:
    """A curated table and its quality history under one folder.

    ``buckets`` is fixed when the table is created; size it so that a bucket stays within a few
    gigabytes.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        # "ignore" leaves an existing table alone.
        settings = spark.createDataFrame([(buckets,)], "buckets int")
        settings.coalesce(1).write.mode("ignore").parquet(f"{self.root}/settings")
        none = spark.createDataFrame([], _STORED)
        none.write.mode("ignore").partitionBy("bucket").parquet(self._data)
        self._totals_schema = partials(none, "bucket").schema
        nothing = spark.createDataFrame([], self._totals_schema)
        nothing.write.mode("ignore").partitionBy("bucket").parquet(self._totals)
        spark.createDataFrame([], S.HISTORY).write.mode("ignore").parquet(self._history)
        self.buckets = spark.read.parquet(f"{self.root}/settings").first().buckets

    @property
    def _data(self) -> str:
        return f"{self.root}/data"

    @property
    def _totals(self) -> str:
        return f"{self.root}/totals"

    @property
    def _history(self) -> str:
        return f"{self.root}/history"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("client_id"), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(_STORED).parquet(self._data)

    def read(self) -> DataFrame:
        """The curated table as of the last merge."""
        return self._stored().select(*S.CURATED_COLUMNS)

    def totals(self) -> DataFrame:
        """Additive totals of the table by bucket, country and status.

        Those of few buckets are read by one task, which spares their reader a shuffle.
        """
        totals = self.spark.read.schema(self._totals_schema).parquet(self._totals)
        return totals.coalesce(1) if self.buckets <= FEW_BUCKETS else totals

    def report(self) -> DataFrame:
        """``store_report`` of the whole table, merged from its totals."""
        return report_of(self.totals())

    def mart(self) -> DataFrame:
        """The status mart of the whole table, merged from its totals."""
        return mart_of(self.totals())

    def _touched(self, rows: DataFrame) -> DataFrame:
        """The stored rows of the buckets that ``rows`` fall into: at most all buckets are listed."""
        touched = [row.bucket for row in rows.select("bucket").distinct().collect()]
        return self._stored().where(F.col("bucket").isin(touched))

    def _replace(self, rows: DataFrame, path: str) -> None:
        """Replace the partitions ``rows`` has rows for, once all of them are written."""
        write = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        write.partitionBy("bucket").parquet(path)

    def merged(self, rows: DataFrame) -> DataFrame:
        """The touched buckets as they are after ``rows``, which hold each client once.

        A small batch is sent to the stored rows, which then stay where they are; beyond that both
        sides are shuffled once.
        """
        arriving = rows.select(
            "client_id",
            F.col("ordered_at").alias("new_at"),
            F.col("tie").alias("new_tie"),
            F.lit(True).alias("meets"),
        )
        beside = lookup_join(self._touched(rows), arriving, "client_id")
        newer = F.struct("ordered_at", "tie") > F.struct(
            F.col("new_at").alias("ordered_at"), F.col("new_tie").alias("tie")
        )
        kept = beside.where(F.col("meets").isNull() | newer).select(*_STORED.names)
        late = beside.where(F.col("meets") & newer).select("client_id")
        won = rows.join(late, "client_id", "left_anti").select(*_STORED.names)
        return kept.unionByName(won.hint("rebalance", "bucket"))

    def upsert(
        self,
        batch: DataFrame,
        order: str | Column,
        processed_at: Column,
        ordered_at: Column | None = None,
        tie: Column | None = None,
    ) -> None:
        """Merge result rows into the table.  Merging the same batch again changes nothing.

        Within the batch the row with the greatest ``order`` wins per client.  Against the table
        the row with the greatest ``ordered_at`` (by default ``processed_at``), then ``tie``, wins,
        then the later merge, so rows that arrive late do not replace newer ones.
        """
        reduced = last_wins(batch, "client_id", order)
        at = processed_at.cast("timestamp")
        rows = reduced.select(
            *S.RESULT_COLUMNS,
            at.alias("processed_at"),
            (at if ordered_at is None else ordered_at.cast("timestamp")).alias("ordered_at"),
            (F.lit(0) if tie is None else tie).cast("long").alias("tie"),
            self._bucket().alias("bucket"),
        )
        rows = materialize(rows)
        self._replace(self.merged(rows), self._data)
        self._replace(partials(self._touched(rows), "bucket"), self._totals)

    def append_history(self, report: DataFrame, run_id: str, run_at: Column) -> None:
        history_row(report, run_id, run_at).write.mode("append").parquet(self._history)

    def history(self) -> DataFrame:
        return self.spark.read.schema(S.HISTORY).parquet(self._history)

    def export(self, path: str) -> str:
        """Write the current table to a folder, issues as JSON text; a run again replaces it."""
        rows = self.read().withColumn("issues", issues_json(F.col("issues")))
        rows.write.mode("overwrite").parquet(path)
        return path
