"""Wash-trading detector: volume windows scored against their symbol's other windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewarden.config import DetectionConfig
from tapewarden.functions.severity import wash_severity
from tapewarden.operators.baselines import with_zscores
from tapewarden.operators.sweeps import wash_sweep
from tapewarden.operators.trades import clean_trades
from tapewarden.operators.windows import volume_windows


def alerts_from_scored(
    scored: DataFrame, threshold: float, detected_at: Column | None = None
) -> DataFrame:
    """Windows whose absolute z-score exceeds the threshold, as alert rows."""
    return scored.filter(F.abs("z_score") > threshold).select(
        "window_start",
        "window_end",
        "symbol",
        F.col("trade_count").cast("int").alias("trade_count"),
        "total_volume",
        "mean_volume",
        "std_volume",
        "z_score",
        wash_severity(F.col("z_score"), threshold).alias("severity"),
        F.lit("WASH_TRADE").alias("alert_type"),
        (F.current_timestamp() if detected_at is None else detected_at).alias("detected_at"),
    )


def scored_windows(trades: DataFrame, config: DetectionConfig) -> DataFrame:
    windows = volume_windows(clean_trades(trades, config.symbols), config.wash_window)
    return with_zscores(windows, config.symbol_bound)


def wash_alerts(
    trades: DataFrame, config: DetectionConfig, detected_at: Column | None = None
) -> DataFrame:
    """Wash alerts of a batch of trades."""
    return alerts_from_scored(scored_windows(trades, config), config.wash_threshold, detected_at)


def wash_sweep_rows(
    trades: DataFrame, config: DetectionConfig, detected_at: Column | None = None
) -> DataFrame:
    """Every window against every threshold of the grid."""
    return wash_sweep(scored_windows(trades, config), config.wash_grid, detected_at)
