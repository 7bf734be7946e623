"""Health counters of running streams."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

TRIGGERS = "stream string, batch_id bigint, input_rows bigint, late_rows bigint, metrics map<string, bigint>"


class StreamCounters(StreamingQueryListener):
    """Totals per stream name: batches, input rows, late rows, observed metrics, failures."""

    def __init__(self) -> None:
        self.totals: Counter = Counter()
        self._names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        self.totals[name, "batches"] += 1
        self.totals[name, "input_rows"] += progress.numInputRows
        for operator in progress.stateOperators:
            self.totals[name, "late_rows"] += operator.numRowsDroppedByWatermark
        for row in progress.observedMetrics.values():
            for metric, value in row.asDict().items():
                self.totals[name, metric] += value or 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:
            self.totals[self._names.get(str(event.id), str(event.id)), "errors"] += 1


def trigger_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row for each recent trigger with input: rows read, rows too late, and the observed metrics.

    A query remembers its last 100 triggers by default.
    """
    rows = {}
    for progress in query.recentProgress:
        if progress.numInputRows:
            late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
            metrics = {k: v or 0 for row in progress.observedMetrics.values() for k, v in row.asDict().items()}
            rows[progress.batchId] = (progress.name or str(progress.id), progress.batchId, progress.numInputRows, late, metrics)
    return spark.createDataFrame(list(rows.values()), TRIGGERS)


def store_triggers(spark: SparkSession, query: StreamingQuery, root: str) -> None:
    """Keep the recent triggers of a query in the table `trigger_counters`; storing one again changes nothing."""
    (
        trigger_rows(spark, query)
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("stream", "batch_id")
        .parquet(f"{root}/trigger_counters")
    )


def read_triggers(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(TRIGGERS).parquet(f"{root}/trigger_counters")
