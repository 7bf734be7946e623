"""Stream sources. The format is an argument: message broker or files alike."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewarden.config import PD_ALERTS_TOPIC, TRADES_TOPIC, WASH_ALERTS_TOPIC
from tapewarden.schema import TRADE
from tapewarden.sources.exchange import decode_trades

_MESSAGE_FIELDS = [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
MESSAGE = T.StructType(_MESSAGE_FIELDS)
TOPIC_MESSAGE = T.StructType([*_MESSAGE_FIELDS, T.StructField("topic", T.StringType())])


def broker_options(
    servers: str, *topics: str, starting: str = "latest", **extra: str
) -> dict[str, str]:
    """Options of Spark's ``kafka`` source for one or more topics."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        **extra,
    }


def trade_broker_options(servers: str, topic: str = TRADES_TOPIC, **extra: str) -> dict[str, str]:
    """Live trades: from the newest offset, tolerating lost data."""
    return broker_options(servers, topic, starting="latest", **extra)


def alert_broker_options(servers: str, **extra: str) -> dict[str, str]:
    """Both alert topics from the start."""
    return broker_options(servers, WASH_ALERTS_TOPIC, PD_ALERTS_TOPIC, starting="earliest", **extra)


def read_stream(
    spark: SparkSession, fmt: str, options: Mapping[str, str], schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**options)
    return (reader if schema is None else reader.schema(schema)).load()


def trade_message_stream(
    spark: SparkSession, fmt: str, options: Mapping[str, str]
) -> DataFrame:
    """Typed trades from a stream of JSON messages (``value`` column)."""
    return decode_trades(read_stream(spark, fmt, options, None if fmt == "kafka" else MESSAGE))


def trade_file_stream(spark: SparkSession, fmt: str, options: Mapping[str, str]) -> DataFrame:
    """Trades from files that already hold the trade columns."""
    return read_stream(spark, fmt, options, TRADE)


def alert_message_stream(
    spark: SparkSession, fmt: str, options: Mapping[str, str]
) -> DataFrame:
    """Alert messages as (topic, value). Files lie in one ``topic=...`` directory per topic."""
    if fmt == "kafka":
        messages = read_stream(spark, fmt, options)
    else:
        messages = read_stream(spark, fmt, options, TOPIC_MESSAGE)
    return messages.select("topic", F.col("value").cast("string").alias("value"))
