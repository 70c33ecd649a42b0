"""Starting stream jobs with recoverable state.

Offsets and state of a streaming query live in its checkpoint location; on a
cluster it must be a shared, fault-tolerant folder so a restarted driver or a
lost executor resumes exactly where the query was.  The location is derived
from the session's ``spark.checkpoint.dir`` (see ``session.checkpoint_dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vitalis.session import checkpoint_dir


def stream_checkpoint(df: DataFrame, name: str) -> str:
    return f"{checkpoint_dir(df.sparkSession).rstrip('/')}/streams/{name}"


def start_parquet_sink(df: DataFrame, path: str, name: str, mode: str = "append", available_now: bool = False,
                       partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """File sink (exactly-once via the sink's own commit log) for append-mode streams."""
    w = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", stream_checkpoint(df, name))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start(path)


def start_foreach_batch(df: DataFrame, fn, name: str, mode: str = "update", available_now: bool = False) -> StreamingQuery:
    """``foreachBatch`` sink (e.g. ``hourly.upsert_hours``) with a recoverable checkpoint."""
    w = df.writeStream.outputMode(mode).foreachBatch(fn).option("checkpointLocation", stream_checkpoint(df, name))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
