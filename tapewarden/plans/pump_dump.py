"""Pump-and-dump detector, threshold sweep and matched-pair report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewarden.config import DetectionConfig
from tapewarden.operators.baselines import with_leave_one_out, with_trailing
from tapewarden.operators.sequences import (
    classify_bars,
    consuming_matches,
    earliest_pairs,
    flagged_at,
    pair_report_columns,
)
from tapewarden.operators.sweeps import pump_dump_sweep
from tapewarden.operators.trades import clean_trades
from tapewarden.operators.windows import ohlcv_bars


def bars_from_trades(trades: DataFrame, config: DetectionConfig) -> DataFrame:
    return ohlcv_bars(clean_trades(trades, config.symbols), config.bar_width)


def rated_bars(bars: DataFrame, config: DetectionConfig, baseline: str) -> DataFrame:
    """Bars with volume ratio and price change.

    ``leave_one_out`` compares a bar with all other bars of the batch,
    ``trailing`` with the earlier ones only (the form a stream can compute).
    """
    if baseline == "leave_one_out":
        return with_leave_one_out(bars, config.symbol_bound)
    if baseline == "trailing":
        return with_trailing(bars)
    raise ValueError(f"unknown baseline: {baseline!r}")


def alerts_from_bars(
    bars: DataFrame,
    config: DetectionConfig,
    baseline: str = "leave_one_out",
    detected_at: Column | None = None,
) -> DataFrame:
    classified = classify_bars(rated_bars(bars, config, baseline), config)
    return consuming_matches(classified, config).withColumn(
        "detected_at", F.current_timestamp() if detected_at is None else detected_at
    )


def pump_dump_alerts(
    trades: DataFrame,
    config: DetectionConfig,
    baseline: str = "leave_one_out",
    detected_at: Column | None = None,
) -> DataFrame:
    """Pump-and-dump alerts of a batch of trades."""
    return alerts_from_bars(bars_from_trades(trades, config), config, baseline, detected_at)


def pump_dump_sweep_rows(
    trades: DataFrame,
    config: DetectionConfig,
    detected_at: Column | None = None,
    grid: Sequence[tuple[float, float]] | None = None,
) -> DataFrame:
    """Every bar, rated by its trailing baseline, against the grid."""
    rated = rated_bars(bars_from_trades(trades, config), config, "trailing")
    return pump_dump_sweep(rated, config.pd_grid if grid is None else grid, detected_at)


def matched_pairs(
    sweep: DataFrame,
    config: DetectionConfig,
    symbol: str | None = None,
    severity: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Matched-pair report over sweep rows; with a ``limit``, the newest pumps.

    Filters apply before the limit.
    """
    flagged = flagged_at(sweep, config.report_point)
    if symbol is not None:
        flagged = flagged.filter(F.col("symbol") == symbol)
    pairs = pair_report_columns(earliest_pairs(flagged, config.pair_window))
    if severity is not None:
        pairs = pairs.filter(F.col("severity") == severity)
    if limit is None:
        return pairs
    return pairs.orderBy(F.desc("pump_start"), "symbol").limit(limit)


def report_point_sweep(
    trades: DataFrame, config: DetectionConfig, detected_at: Column | None = None
) -> DataFrame:
    """Sweep rows of the report's grid point alone, for reports straight from trades."""
    return pump_dump_sweep_rows(trades, config, detected_at, grid=[config.report_point])
