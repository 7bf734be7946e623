"""Alert messages to keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewarden.operators.alerts import (
    ALERT_TABLE_OF_TOPIC,
    check_constraints,
    critical_feed,
    decode_alerts,
    route_alerts,
)
from tapewarden.sinks.keyed import insert_ignore_tagged
from tapewarden.streaming.jobs import TRIGGER, start

ALERT_TABLES = tuple(ALERT_TABLE_OF_TOPIC.values())


def judged_alerts(messages: DataFrame) -> DataFrame:
    """Messages of all tables in one frame: decoded columns, ``target_table`` and ``constraint_error``.

    A message of an unknown topic has the error ``unknown_topic`` and no table.
    """
    routed = route_alerts(messages)
    judged = routed.filter(F.col("target_table").isNull()).withColumn("constraint_error", F.lit("unknown_topic"))
    for topic, table in ALERT_TABLE_OF_TOPIC.items():
        mine = routed.filter(F.col("target_table") == table.name)
        rows = check_constraints(decode_alerts(mine, table), table).withColumns(
            {"target_table": F.lit(table.name), "topic": F.lit(topic)}
        )
        judged = judged.unionByName(rows, allowMissingColumns=True)
    return judged


def start_alert_persister(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    writer: str = "alerts",
) -> StreamingQuery:
    """Route, check and store alert messages; nothing is lost on a bad one.

    Good rows go to the two alert tables (first wins), CRITICAL ones also to
    ``critical_alerts``; messages of unknown topics or with broken constraints
    go to ``rejected_alerts`` with the reason. Either place is there from its
    first row on. Offsets move only after all writes, and the key makes a
    replayed batch harmless.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # Read once; every message decoded and checked once, for all outputs.
        read = batch.persist()
        judged = judged_alerts(read).persist()
        try:
            reason, table = F.col("constraint_error"), F.col("target_table")
            critical = reason.isNull() & (F.col("severity") == "CRITICAL")
            # As many rows as the batch touches folders, and one a table for what is rejected.
            summary = (
                judged.groupBy(table, F.when(reason.isNull(), F.to_date("window_start")).alias("day"))
                .agg(F.count(reason).alias("bad"), F.count_if(critical).alias("critical"))
                .collect()
            )
            touched = {
                t.name: sorted(r.day for r in summary if r.target_table == t.name and r.day is not None)
                for t in ALERT_TABLES
            }
            insert_ignore_tagged(judged.filter(reason.isNull()), root, ALERT_TABLES, batch_id, touched, writer)
            own = f"writer={writer}/batch_id={batch_id}"
            if any(r.bad for r in summary):
                rejected = judged.filter(reason.isNotNull()).select("topic", "value", reason.alias("reason"))
                rejected.write.mode("overwrite").parquet(f"{root}/rejected_alerts/{own}")
            if any(r.critical for r in summary):
                feed = None
                for t in ALERT_TABLES:
                    rows = critical_feed(judged.filter(critical & (table == t.name)).select(*t.schema.names))
                    feed = rows if feed is None else feed.unionByName(rows)
                feed.write.mode("overwrite").parquet(f"{root}/critical_alerts/{own}")
        finally:
            judged.unpersist()
            read.unpersist()

    observed = messages.observe("alerts", F.count(F.lit(1)).alias("messages"))
    return start(observed, store, checkpoint, "append", trigger, writer)
