"""Starting streams: session settings, triggers, checkpoints."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

TRIGGER = "15 seconds"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful streams; the caller's settings stay untouched.

    The number of state partitions is fixed for the life of a checkpoint, so
    size it for the keys to come. State lives in RocksDB, outside the heap.
    """
    session = spark.newSession()
    count = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(count))
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    return session


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    trigger: str | None = TRIGGER,
    name: str | None = None,
) -> StreamingQuery:
    """Run ``handle`` per micro-batch. ``trigger=None`` drains what is available and stops."""
    writer = (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )
    return _go(writer, trigger, name)


def start_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: str | None = TRIGGER,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to files; Spark's file sink commits each batch exactly once."""
    writer = (
        stream.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _go(writer, trigger, name)


def _go(writer, trigger: str | None, name: str | None) -> StreamingQuery:
    if name is not None:
        writer = writer.queryName(name)
    due = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return writer.trigger(**due).start()


def batch_time(detected_at: Column | None) -> Column:
    """Detection time of a batch: one value for all its outputs."""
    return F.lit(datetime.now(timezone.utc)) if detected_at is None else detected_at


def each_nonempty(handle: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Persist the batch for several outputs, skip it when empty, always release it."""

    def run(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            if not held.isEmpty():
                handle(held, batch_id)
        finally:
            held.unpersist()

    return run
