"""Streams: documents refreshed as they arrive, and windows over events. The same operators run on each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarryline.operators.relational import full_outer_delta
from quarryline.sources.sinks import MergedTable


def refresh_documents(stream: DataFrame, target: MergedTable, digest: str, checkpoint: str, on_delta: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Keeps a table current with a stream of whole documents (R31): of a batch's rows of one key the last by digest counts.

    A batch writes only the buckets that it changes; one that changes nothing writes no version, so that a batch run again after a failure leaves the table as it is.
    """
    keys = target.keys

    def apply(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c not in (*keys, digest)]
        incoming = batch.groupBy(*keys).agg(F.max(F.struct(digest, *rest)).alias("_r")).select(*keys, "_r.*").select(*batch.columns)
        changed = incoming
        if target.current() is not None:
            delta = full_outer_delta(target.read(batch.sparkSession).join(incoming.select(*keys), keys, "left_semi"), incoming, keys, [digest])
            if on_delta is not None:
                on_delta(delta, number)
            changed = incoming.join(delta.where("delta IN ('added', 'updated')").select(*keys), keys, "left_semi")
        target.merge(changed)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """(start, event_type, n, total): tumbling windows with a watermark; for batches and streams. events: (ts, event_type, value)."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("ts", late)
    rows = timed.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rows.select(F.col("window.start").alias("start"), "event_type", "n", "total")
