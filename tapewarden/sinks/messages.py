"""Key/value messages for a broker or for message files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewarden.functions.timestamps import ISO_MESSAGE_FORMAT
from tapewarden.schema import TRADE

_JSON = {"timestampFormat": ISO_MESSAGE_FORMAT}


def encode_trades(trades: DataFrame) -> DataFrame:
    """Trades as JSON keyed by symbol; the key keeps a symbol in one broker partition."""
    if "timestamp" not in trades.columns:
        trades = trades.withColumn("timestamp", F.date_format("event_time", ISO_MESSAGE_FORMAT))
    present = [name for name in TRADE.names if name in trades.columns]
    return trades.select(
        F.col("symbol").alias("key"), F.to_json(F.struct(*present), _JSON).alias("value")
    )


def encode_alerts(alerts: DataFrame, topic: str) -> DataFrame:
    """Alerts as JSON with ISO times, and the topic they go to."""
    body = F.to_json(F.struct(*alerts.columns), {**_JSON, "ignoreNullFields": "false"})
    return alerts.select(
        F.lit(topic).alias("topic"), F.col("symbol").alias("key"), body.alias("value")
    )


@dataclass(frozen=True)
class MessageTarget:
    """Where messages go: a broker (``kafka`` and its options) or message files."""

    fmt: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None

    def publish(self, alerts: DataFrame, topic: str) -> None:
        """Send alerts; a replayed batch sends them again, which keyed tables absorb."""
        write_messages(encode_alerts(alerts, topic), self.fmt, self.options, self.path)


def write_messages(
    messages: DataFrame, fmt: str, options: Mapping[str, str], path: str | None = None
) -> None:
    """Write from the executors: to a broker (``kafka``), or to files split by topic.

    For a broker the ``topic`` column, when present, names the target.
    """
    writer = messages.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
        return
    if "topic" in messages.columns:
        writer = writer.partitionBy("topic")
    writer.mode("append").save(path)
