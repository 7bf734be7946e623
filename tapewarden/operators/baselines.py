"""Volume baselines per symbol, z-scores and volume ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewarden.functions.pricing import guarded_ratio, price_change
from tapewarden.operators.blocks import DAY, bounded_broadcast, planned_alike, trailing_totals


def volume_baseline(windows: DataFrame) -> DataFrame:
    """Mean and sample std of window volume per symbol (partial aggregation first)."""
    return windows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("window_count"),
        F.avg("total_volume").alias("baseline_mean"),
        F.stddev_samp("total_volume").alias("baseline_std"),
    )


def with_zscores(windows: DataFrame, symbol_bound: int | None = None) -> DataFrame:
    """Add ``z_score`` of a window's volume among all windows of its symbol.

    0 where the symbol has one window or no spread.
    """
    shared = planned_alike(windows)
    baseline = volume_baseline(shared).drop("window_count")
    spread = F.col("baseline_std")
    z_score = F.when(
        spread > 0, (F.col("total_volume") - F.col("baseline_mean")) / spread
    ).otherwise(F.lit(0.0))
    return (
        shared.join(bounded_broadcast(baseline, symbol_bound), "symbol")
        .withColumn("z_score", z_score)
        .drop("baseline_mean", "baseline_std")
    )


def _with_ratio(bars: DataFrame) -> DataFrame:
    return bars.withColumn(
        "volume_ratio", guarded_ratio(F.col("total_volume"), F.col("baseline_volume"))
    ).withColumn("price_change", price_change(F.col("open_price"), F.col("close_price")))


def with_leave_one_out(bars: DataFrame, symbol_bound: int | None = None) -> DataFrame:
    """Ratio to the mean volume of all *other* bars of the symbol; a lone bar's is its own."""
    shared = planned_alike(bars)
    totals = shared.groupBy("symbol").agg(
        F.count("total_volume").alias("_n"), F.sum("total_volume").alias("_s")
    )
    volume = F.col("total_volume")
    others = F.when(F.col("_n") > 1, (F.col("_s") - volume) / (F.col("_n") - 1)).otherwise(volume)
    return _with_ratio(
        shared.join(bounded_broadcast(totals, symbol_bound), "symbol")
        .withColumn("baseline_volume", others)
        .drop("_n", "_s")
    )


def with_trailing(
    bars: DataFrame, carried: DataFrame | None = None, symbol_bound: int | None = None, seconds: int = DAY
) -> DataFrame:
    """Ratio to the mean volume of the *earlier* bars of the symbol; the first bar's is its own.

    ``carried`` (symbol, bars, volume) counts bars of each symbol before these.
    """
    totals = trailing_totals(bars, ["symbol"], "window_start", "total_volume", seconds)
    count, volume = F.col("_prior_count"), F.col("_prior_sum")
    if carried is not None:
        before = carried.select("symbol", F.col("bars").alias("_bars0"), F.col("volume").alias("_volume0"))
        totals = totals.join(bounded_broadcast(before, symbol_bound), "symbol", "left")
        count = count + F.coalesce("_bars0", F.lit(0))
        volume = volume + F.coalesce("_volume0", F.lit(0.0))
    earlier = F.when(count > 0, volume / count).otherwise(F.col("total_volume"))
    return _with_ratio(
        totals.withColumn("baseline_volume", earlier).drop("_prior_count", "_prior_sum", "_bars0", "_volume0")
    )
