"""Tumbling volume windows and OHLCV bars.

Both work on batch and streaming frames. The grouping key holds the window,
so a hot symbol is spread over its windows, and partial aggregation runs
before the shuffle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _flat(grouped: DataFrame) -> DataFrame:
    rest = [c for c in grouped.columns if c not in ("window", "symbol")]
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "symbol",
        *rest,
    )


def volume_windows(trades: DataFrame, width: str) -> DataFrame:
    """Trade count and total, mean and sample std of quantity per window."""
    quantity = F.col("quantity")
    return _flat(
        trades.groupBy(F.window("event_time", width), "symbol").agg(
            F.count(F.lit(1)).alias("trade_count"),
            F.sum(quantity).alias("total_volume"),
            F.coalesce(F.avg(quantity), F.lit(0.0)).alias("mean_volume"),
            F.coalesce(F.stddev_samp(quantity), F.lit(0.0)).alias("std_volume"),
        )
    )


def trade_order() -> Column:
    """Total order of trades in event time as one decimal.

    Trades of one instant are told apart by the exchange's numeric id, other
    ids by their hash. A decimal fits the in-place buffers of hash
    aggregation; ordering by a struct would make Spark sort all trades first.
    """
    order_id = F.col("order_id")
    tie = F.coalesce(
        order_id.try_cast("bigint"),
        F.xxhash64(order_id).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF)),
    )
    micros = F.unix_micros("event_time").cast("decimal(18,0)")
    return micros * F.lit(Decimal(10**19)) + tie.cast("decimal(19,0)")


def ohlcv_bars(trades: DataFrame, width: str, keep_event_time: bool = False) -> DataFrame:
    """Open, high, low, close, volume and count per window, in event-time order.

    ``keep_event_time`` adds the window's event time for stateful operators
    that follow in a streaming plan.
    """
    bars = trades.groupBy(F.window("event_time", width), "symbol").agg(
        F.min_by("price", trade_order()).alias("open_price"),
        F.max_by("price", trade_order()).alias("close_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.sum("quantity").alias("total_volume"),
        F.count(F.lit(1)).alias("trade_count"),
    )
    if keep_event_time:
        bars = bars.withColumn("event_time", F.window_time("window"))
    return _flat(bars)
