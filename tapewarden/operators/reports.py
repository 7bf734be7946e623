"""Report queries over alert tables; one frame per panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weight of an alert in a symbol's risk score.
RISK_WEIGHTS = (("CRITICAL", 3), ("HIGH", 2), ("MEDIUM", 1))


def severity_breakdown(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_type", "severity").agg(F.count(F.lit(1)).alias("alerts"))


def average_zscore(wash: DataFrame) -> DataFrame:
    return wash.groupBy("symbol").agg(F.avg("z_score").alias("avg_z_score"))


def _tagged(wash: DataFrame, pump_dump: DataFrame, *columns: str) -> DataFrame:
    """Both kinds cut to what a count needs, with a label."""
    return wash.select(*columns, F.lit("wash").alias("kind")).unionByName(
        pump_dump.select(*columns, F.lit("pump_dump").alias("kind"))
    )


def overview(wash: DataFrame, pump_dump: DataFrame) -> DataFrame:
    """One row: alerts in all, per kind, critical ones, distinct symbols.

    Counts are taken per symbol first, so the distinct count needs no second
    pass over the alerts.
    """
    per_symbol = (
        _tagged(wash, pump_dump, "symbol", "severity")
        .groupBy("symbol")
        .agg(
            F.count_if(F.col("kind") == "wash").alias("wash"),
            F.count_if(F.col("kind") == "pump_dump").alias("pump_dump"),
            F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
        )
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return per_symbol.agg(
        (total("wash") + total("pump_dump")).alias("total_alerts"),
        total("wash").alias("wash_alerts"),
        total("pump_dump").alias("pump_dump_alerts"),
        total("critical").alias("critical_alerts"),
        F.count("symbol").alias("symbols_flagged"),
    )


def timeline(wash: DataFrame, pump_dump: DataFrame) -> DataFrame:
    """Alerts per minute and type; wash by detection, pairs by when the pump began."""
    # The two names of alert types in a timeline.
    placed = wash.select(
        F.col("detected_at").alias("at"), F.lit("Wash Trade").alias("alert_type")
    ).unionByName(
        pump_dump.select(
            F.col("window_start").alias("at"), F.lit("Pump & Dump").alias("alert_type")
        )
    )
    return placed.groupBy(F.date_trunc("minute", "at").alias("minute"), "alert_type").agg(
        F.count(F.lit(1)).alias("alerts")
    )


def symbol_risk(wash: DataFrame, pump_dump: DataFrame, symbols: DataFrame) -> DataFrame:
    """Alert counts and weighted risk per symbol of the dimension, highest risk first."""
    weight = F.lit(0)
    for severity, points in RISK_WEIGHTS:
        weight = F.when(F.col("severity") == severity, points).otherwise(weight)
    counted = (
        _tagged(wash, pump_dump, "symbol", "severity")
        .groupBy("symbol")
        .agg(
            F.count_if(F.col("kind") == "wash").alias("wash_alerts"),
            F.count_if(F.col("kind") == "pump_dump").alias("pump_dump_alerts"),
            F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
            F.sum(weight).alias("risk_score"),
        )
    )
    numbers = ["wash_alerts", "pump_dump_alerts", "critical", "risk_score"]
    return (
        symbols.select("symbol")
        .distinct()
        .join(counted, "symbol", "left")
        .fillna(0, numbers)
        .orderBy(F.desc("risk_score"), "symbol")
    )


def date_range(alerts: DataFrame, kept: Column) -> DataFrame:
    """First and last detection, and rows before and after a filter."""
    return alerts.groupBy("alert_type").agg(
        F.min("detected_at").alias("first_detected"),
        F.max("detected_at").alias("last_detected"),
        F.count(F.lit(1)).alias("raw_count"),
        F.count_if(kept).alias("filtered_count"),
    )


def recent_counts(alerts: DataFrame, since: Column, symbol: str | None = None) -> DataFrame:
    """Alerts detected after ``since``, per type, optionally of one symbol."""
    recent = alerts.filter(F.col("detected_at") > since)
    if symbol is not None:
        recent = recent.filter(F.col("symbol") == symbol)
    return recent.groupBy("alert_type").agg(F.count(F.lit(1)).alias("alerts"))


def flagged_symbols(wash: DataFrame, pump_dump: DataFrame) -> DataFrame:
    return wash.select("symbol").union(pump_dump.select("symbol")).distinct()


def recent_wash_table(wash: DataFrame, rows: int = 50) -> DataFrame:
    """Newest wash alerts with the report's columns."""
    return (
        wash.select(
            "detected_at", "symbol", "severity", "z_score", "total_volume", "mean_volume",
            "trade_count", "window_start", "window_end",
        )
        .orderBy(F.desc("detected_at"), "symbol")
        .limit(rows)
    )


def pair_table(pairs: DataFrame, rows: int = 50) -> DataFrame:
    """Newest matched pairs with display names and texts."""

    def text(pattern: str, name: str) -> Column:
        return F.coalesce(F.when(F.col(name).isNotNull(), F.format_string(pattern, name)), F.lit(""))

    newest = pairs.orderBy(F.desc("detected_at"), "symbol", "pump_start").limit(rows)
    # Column titles and number formats.
    return newest.select(
        "detected_at",
        "symbol",
        "severity",
        text("%.4f%%", "pump_price_chg_pct").alias("Pump %"),
        text("%.4f%%", "dump_price_chg_pct").alias("Dump %"),
        text("%.2f×", "pump_vol_ratio").alias("Pump Vol×"),
        text("%.2f×", "dump_vol_ratio").alias("Dump Vol×"),
        F.col("pump_start").alias("Pump Time"),
        F.col("dump_start").alias("Dump Time"),
    )


def pair_points(pairs: DataFrame) -> DataFrame:
    """Pump against dump change of each pair."""
    return pairs.select(
        "symbol", "detected_at", "severity", "pump_price_chg_pct", "dump_price_chg_pct"
    )


def symbol_dimension(alerts_or_trades: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    """Symbol table from a fixed list, else the distinct symbols of the data."""
    if symbols is None:
        return alerts_or_trades.select("symbol").distinct()
    listed = F.explode(F.array(*[F.lit(s) for s in symbols])).alias("symbol")
    return alerts_or_trades.sparkSession.range(1).select(listed)
