"""Threshold sweeps: every window or bar against every grid point.

The grid is a literal array, so the product is a generator inside the scan's
stage and needs no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewarden.functions.pricing import percent
from tapewarden.functions.severity import sweep_severity, wash_severity


def _detected(detected_at: Column | None) -> Column:
    return (F.current_timestamp() if detected_at is None else detected_at).alias("detected_at")


def wash_sweep(
    scored: DataFrame, grid: Sequence[float], detected_at: Column | None = None
) -> DataFrame:
    """One row per window and threshold; severity only where flagged."""
    points = F.array(*[F.lit(float(t)) for t in grid])
    flagged = F.abs("z_score") > F.col("threshold")
    return (
        scored.withColumn("threshold", F.explode(points))
        .withColumn("flagged", flagged)
        .select(
            "window_start",
            "window_end",
            "symbol",
            F.col("trade_count").cast("int").alias("trade_count"),
            "total_volume",
            "z_score",
            "threshold",
            "flagged",
            F.when(
                F.col("flagged"), wash_severity(F.col("z_score"), F.col("threshold"))
            ).alias("severity"),
            _detected(detected_at),
        )
    )


def pump_dump_sweep(
    rated: DataFrame, grid: Sequence[tuple[float, float]], detected_at: Column | None = None
) -> DataFrame:
    """One row per bar, (price, volume) threshold pair and phase.

    ``rated`` bars carry the trailing baseline; bars without a positive open
    price give no rows.
    """
    points = F.array(
        *[
            F.struct(
                F.lit(float(price)).alias("price_threshold"),
                F.lit(float(volume)).alias("vol_threshold"),
                F.lit(phase).alias("phase"),
            )
            for price, volume in grid
            for phase in ("PUMP", "DUMP")
        ]
    )
    bars = rated.filter(F.col("open_price") > 0).select(
        "window_start", "window_end", "symbol", "price_change", "volume_ratio"
    )
    change, ratio = F.col("price_change"), F.col("volume_ratio")
    directed = F.when(F.col("phase") == "PUMP", change).otherwise(-change)
    flagged = (directed >= F.col("price_threshold")) & (ratio >= F.col("vol_threshold"))
    return (
        bars.withColumn("_point", F.explode(points))
        .select("*", "_point.*")
        .withColumn("flagged", flagged)
        .select(
            "window_start",
            "window_end",
            "symbol",
            percent(change, 6).alias("price_change_pct"),
            F.round(ratio, 4).alias("volume_ratio"),
            "price_threshold",
            "vol_threshold",
            "phase",
            "flagged",
            F.when(
                F.col("flagged"), sweep_severity(change, F.col("price_threshold"))
            ).alias("severity"),
            _detected(detected_at),
        )
    )


def _rate(hits: Column, total: Column) -> Column:
    return F.round(hits * 100.0 / total, 4)


def wash_sweep_summary(sweep: DataFrame) -> DataFrame:
    """Windows, alerts and alert rate per threshold."""
    totals = sweep.groupBy(F.col("threshold").alias("z_threshold")).agg(
        F.count(F.lit(1)).alias("total_windows"),
        F.count_if("flagged").alias("alerts_fired"),
    )
    return totals.withColumn(
        "alert_rate_pct", _rate(F.col("alerts_fired"), F.col("total_windows"))
    )


def pump_dump_sweep_summary(sweep: DataFrame) -> DataFrame:
    """Bars, pumps, dumps and alert rate per (price, volume) threshold pair.

    Each bar has exactly one PUMP row per grid point, so counting those counts
    the bars without a distinct.
    """
    is_pump = F.col("phase") == "PUMP"
    totals = sweep.groupBy(
        "price_threshold", F.col("vol_threshold").alias("volume_ratio")
    ).agg(
        F.count_if(is_pump).alias("total_bars"),
        F.count_if(is_pump & F.col("flagged")).alias("pumps_detected"),
        F.count_if(~is_pump & F.col("flagged")).alias("dumps_detected"),
    )
    hits = F.col("pumps_detected") + F.col("dumps_detected")
    return totals.withColumn("alert_rate_pct", _rate(hits, F.col("total_bars")))
