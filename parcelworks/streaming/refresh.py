"""Refresh of a shipment history from a stream of tracking rows.

Each micro-batch goes through the same upsert as the batch refresh, on the buckets of its
own keys. The batch of the history follows the number of the micro-batch, so one that is
replayed after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from parcelworks.operators.upsert import upsert_freeze_completed
from parcelworks.sources import history
from parcelworks.sources.sinks import current_version, publish, read_published


def refresh_history(rows: DataFrame, root: str, key: str, version: int | None = None) -> int:
    """Upsert tracking rows into the published history; finished shipments stay as they are."""
    spark = rows.sparkSession
    current = current_version(spark, root)
    if current is None:
        return publish(rows, root, version)
    if version is not None and version <= current[0]:
        return current[0]
    merged = upsert_freeze_completed(read_published(spark, root), rows, key)
    return publish(merged, root, version)


def stream_refresh(stream: DataFrame, root: str, key: str, checkpoint: str) -> DataStreamWriter:
    """A writer that refreshes the history under ``root`` (``start_history``) once per micro-batch."""

    def upsert(batch: DataFrame, number: int) -> None:
        history.refresh(batch, root, key, batch=1 + number)

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
