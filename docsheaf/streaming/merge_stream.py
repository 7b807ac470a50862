"""Landed pages as a stream, merged into a keyed table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import collapse
from ..sinks.store import StoredTable


def one_per_version(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Drop repeats of a document's version; the watermark bounds the state.

    A version is the id with its time, so a changed document passes. Rows that
    come later than ``delay`` are dropped as well: choose it so that none do,
    or leave the repeats to the merge, which needs no state.
    """
    # A watermark wants an instant; the zone-free time itself stays as it is.
    timed = stream.withColumn("__instant", F.col(time).cast("timestamp"))
    unique = timed.withWatermark("__instant", delay).dropDuplicatesWithinWatermark([key, time])
    return unique.drop("__instant")


def merge_stream(
    stream: DataFrame, table: StoredTable, time: str, checkpoint: str, delay: str | None = None,
    after: Callable[[DataFrame, int], None] | None = None, strict: bool = False,
) -> StreamingQuery:
    """Merge everything that has landed and stop.

    Repeats, late rows and replayed micro-batches are all harmless: within a
    micro-batch the newest value of each column wins, and against the table an
    older version only fills nulls. ``delay`` asks for state that spares the
    merge the repeats, at the price stated above. ``after`` runs once the
    merge of a batch is committed, which is the time to record progress.
    """
    def one_batch(batch: DataFrame, number: int) -> None:
        rows = collapse(batch, table.key, F.col(time))
        if after is None:
            table.merge(rows, strict, time)
            return
        rows.persist()
        try:
            table.merge(rows, strict, time)
            after(rows, number)
        finally:
            rows.unpersist()

    if delay is not None:
        stream = one_per_version(stream, table.key, time, delay)
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).foreachBatch(one_batch).start()
