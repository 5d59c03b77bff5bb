"""Verifying client records as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from concordat import schemas as S
from concordat.operators.curated import CuratedStore
from concordat.operators.validation import validate
from concordat.sources.upload import accepted, rejected


def verify_stream(
    arrivals: DataFrame,
    registry: DataFrame,
    store: CuratedStore,
    checkpoint: str,
    *,
    event_time: str = "event_time",
    rejects: str | None = None,
    trigger: dict | None = None,
    **rules,
) -> StreamingQuery:
    """Check each arriving client record against the registry and merge it into the store.

    Per client the record with the greatest event time stands, however late or out of order records
    come, in one micro-batch or in several; of two at one time the one whose content has the greater
    hash.  Nothing is dropped for being late, and no state is kept beside the store.  The merge is
    keyed, so repeats and a micro-batch that runs again leave the store as it was.  Records without
    a client id go to ``rejects`` (by default a folder of the store), one folder for each
    micro-batch.  ``trigger`` is passed on, for instance ``{"availableNow": True}``.
    """
    refused = rejects or f"{store.root}/rejects"

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            results = validate(accepted(batch), registry, keep=(event_time,), **rules)
            tied = results.withColumn("tie", F.xxhash64(*S.RESULT_COLUMNS))
            time, tie = F.col(event_time), F.col("tie")
            store.upsert(tied, F.struct(event_time, "tie"), time, time, tie)
            lost = rejected(batch)
            if not lost.isEmpty():
                lost.write.mode("overwrite").parquet(f"{refused}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = arrivals.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()
