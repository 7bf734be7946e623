"""Windows and bars from parts that merge: what trades of one trigger add to them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewarden.operators.windows import trade_order

_KEY = ("window_start", "window_end", "symbol")
_VOLUME = "window_start timestamp, window_end timestamp, symbol string, trade_count bigint, total_volume double, parts array<struct<n: bigint, mean: double, deviation: double>>"
_BAR = (
    "window_start timestamp, window_end timestamp, symbol string, open_price double, close_price double, "
    "high_price double, low_price double, total_volume double, trade_count bigint, "
    "first_order decimal(38,0), last_order decimal(38,0)"
)


@dataclass(frozen=True)
class Partials:
    """How parts of a kind of window are made from trades, merged, and read as whole windows."""

    schema: str
    of_trades: Callable[[DataFrame, str], DataFrame]
    merged: Callable[[DataFrame], DataFrame]
    whole: Callable[[DataFrame], DataFrame]


def _windowed(trades: DataFrame, width: str) -> DataFrame:
    return trades.withColumn("_w", F.window("event_time", width)).withColumns(
        {"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}
    )


def _volume_parts(trades: DataFrame, width: str) -> DataFrame:
    quantity = F.col("quantity")
    counted = _windowed(trades, width).groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(quantity).alias("total_volume"),
        F.avg(quantity).alias("mean"),
        F.var_pop(quantity).alias("_v"),
    )
    part = F.struct(
        F.col("trade_count").alias("n"), F.col("mean"), (F.col("_v") * F.col("trade_count")).alias("deviation")
    )
    return counted.select(*_KEY, "trade_count", "total_volume", F.array(part).alias("parts"))


def _one_part(parts: Column) -> Column:
    """Count, mean and squared deviation of several parts together."""

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["deviation"] + b["deviation"] + apart * apart * a["n"] * b["n"] / n).alias("deviation"),
        )

    return F.aggregate(F.slice(parts, 2, F.size(parts)), parts[0], add)


def _volume_merged(parts: DataFrame) -> DataFrame:
    # A window has as many parts as triggers have brought trades for it since they were last merged.
    return (
        parts.groupBy(*_KEY)
        .agg(
            F.sum("trade_count").alias("trade_count"),
            F.sum("total_volume").alias("total_volume"),
            F.flatten(F.collect_list("parts")).alias("parts"),
        )
        .withColumn("parts", F.array(_one_part(F.col("parts"))))
    )


def _volume_whole(merged: DataFrame) -> DataFrame:
    part = F.col("parts")[0]
    spread = F.when(part["n"] > 1, F.sqrt(part["deviation"] / F.greatest(part["n"] - 1, F.lit(1)))).otherwise(0.0)
    return merged.select(
        *_KEY, "trade_count", "total_volume", part["mean"].alias("mean_volume"), spread.alias("std_volume")
    )


def _bar_parts(trades: DataFrame, width: str) -> DataFrame:
    order = trade_order()
    return _windowed(trades, width).groupBy(*_KEY).agg(
        F.min_by("price", order).alias("open_price"),
        F.max_by("price", order).alias("close_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.sum("quantity").alias("total_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.min(order).alias("first_order"),
        F.max(order).alias("last_order"),
    )


def _bars_merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*_KEY).agg(
        F.min_by("open_price", "first_order").alias("open_price"),
        F.max_by("close_price", "last_order").alias("close_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("trade_count").alias("trade_count"),
        F.min("first_order").alias("first_order"),
        F.max("last_order").alias("last_order"),
    )


VOLUME = Partials(_VOLUME, _volume_parts, _volume_merged, _volume_whole)
BAR = Partials(_BAR, _bar_parts, _bars_merged, lambda merged: merged.drop("first_order", "last_order"))
