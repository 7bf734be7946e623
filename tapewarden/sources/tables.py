"""Tables at rest: keyed tables and event tables standing in for trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.readStream.schema(EVENTS)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    )


def event_quantity() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def trades_from_events(events: DataFrame) -> DataFrame:
    """The events table read as executed trades (batch or streaming)."""
    side = F.when(F.col("user_id") % 2 == 0, "BUY").otherwise("SELL")
    return events.select(
        F.col("event_id").cast("string").alias("trade_id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        event_quantity().alias("quantity"),
        side.alias("side"),
        F.col("event_id").cast("string").alias("order_id"),
        F.lit("TRADE").alias("event_type"),
        F.col("user_id").cast("string").alias("trader_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )
