"""Bar phases and PUMP to DUMP matching.

Matching never looks further than the pair window, so bars are cut into time
blocks with context rows from the neighbour block: work per task is bounded
by the block, not by a symbol's history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewarden.config import DetectionConfig, interval_seconds
from tapewarden.functions.pricing import bar_phase, percent
from tapewarden.functions.severity import pump_dump_severity, report_severity
from tapewarden.functions.timestamps import time_block
from tapewarden.operators.blocks import DAY, bounded_broadcast, spread_over_blocks


def _block_seconds(pair_seconds: int) -> int:
    """At least a day, else the shortest block that holds the pair window."""
    return max(DAY, pair_seconds)


def with_phases(rated: DataFrame, config: DetectionConfig) -> DataFrame:
    """Add ``phase``: PUMP, DUMP or null; null also where a bar has no positive open price."""
    phase = bar_phase(
        F.col("price_change"),
        F.col("volume_ratio"),
        config.pump_threshold,
        config.dump_threshold,
        config.volume_ratio,
    )
    return rated.withColumn("phase", F.when(F.col("open_price") > 0, phase))


def classify_bars(rated: DataFrame, config: DetectionConfig) -> DataFrame:
    """Add ``phase`` (PUMP, DUMP or null); bars without a positive open price are left out.

    The baseline is already computed, so those bars still count in it.
    """
    return with_phases(rated.filter(F.col("open_price") > 0), config)


def consuming_matches(classified: DataFrame, config: DetectionConfig) -> DataFrame:
    """Each DUMP whose previous PUMP-or-DUMP bar is a PUMP inside the pair window.

    This closed form equals a state machine in which a later PUMP replaces the
    remembered one and a matching DUMP consumes it: a bar has one phase, and a
    PUMP once out of range never comes back into it.
    """
    seconds = interval_seconds(config.pair_window)
    marked = classified.filter(F.col("phase").isNotNull()).select(
        "symbol", "window_start", "phase", "price_change", "volume_ratio"
    )
    spread = spread_over_blocks(
        marked, "window_start", _block_seconds(seconds), lookback=seconds
    )
    order = Window.partitionBy("symbol", "_block").orderBy("window_start")
    previous = F.lag(F.struct("phase", "window_start", "price_change")).over(order)
    limit = F.col("_prev.window_start") + F.make_dt_interval(secs=F.lit(seconds))
    return (
        spread.withColumn("_prev", previous)
        .filter(
            F.col("_home")
            & (F.col("phase") == "DUMP")
            & (F.col("_prev.phase") == "PUMP")
            & (F.col("window_start") <= limit)
        )
        .select(
            F.col("_prev.window_start").alias("window_start"),
            F.col("window_start").alias("window_end"),
            "symbol",
            F.lit("DUMP").alias("phase"),
            percent(F.col("_prev.price_change"), 4).alias("pump_price_chg_pct"),
            percent(F.col("price_change"), 4).alias("dump_price_chg_pct"),
            percent(F.col("price_change"), 4).alias("price_change_pct"),
            F.round("volume_ratio", 4).alias("volume_ratio"),
            pump_dump_severity(F.col("price_change"), config.dump_threshold).alias("severity"),
            F.lit("PUMP_DUMP").alias("alert_type"),
        )
    )


def flagged_at(sweep: DataFrame, point: tuple[float, float]) -> DataFrame:
    """Flagged sweep rows of one grid point."""
    price, volume = point
    return sweep.filter(
        F.col("flagged") & (F.col("price_threshold") == price) & (F.col("vol_threshold") == volume)
    )


def candidate_pairs(flagged: DataFrame, pair_window: str) -> DataFrame:
    """Every PUMP with every later DUMP of its symbol inside the pair window.

    The range join is an equi join on (symbol, block): a PUMP goes to its own
    block and, when its window reaches over the border, to the next one; a
    DUMP goes to its own only, so a pair meets exactly once. Blocks are one
    pair window long, so a PUMP is compared with the DUMPs of two windows.
    """
    seconds = interval_seconds(pair_window)
    pump = (
        flagged.filter(F.col("phase") == "PUMP")
        .select(
            "symbol",
            F.col("window_start").alias("pump_start"),
            F.col("window_end").alias("pump_end"),
            F.col("price_change_pct").alias("pump_price_chg_pct"),
            F.col("volume_ratio").alias("pump_vol_ratio"),
            F.col("detected_at").alias("_pump_seen"),
        )
        .transform(lambda df: spread_over_blocks(df, "pump_start", seconds, lookback=seconds))
        .drop("_home")
    )
    dump = flagged.filter(F.col("phase") == "DUMP").select(
        "symbol",
        F.col("window_start").alias("dump_start"),
        F.col("window_end").alias("dump_end"),
        F.col("price_change_pct").alias("dump_price_chg_pct"),
        F.col("volume_ratio").alias("dump_vol_ratio"),
        F.col("detected_at").alias("_dump_seen"),
        time_block(F.col("window_start"), seconds).alias("_block"),
    )
    limit = F.col("pump_start") + F.make_dt_interval(secs=F.lit(seconds))
    return (
        pump.join(dump, ["symbol", "_block"])
        .filter((F.col("dump_start") > F.col("pump_start")) & (F.col("dump_start") <= limit))
        .withColumn("detected_at", F.greatest("_pump_seen", "_dump_seen"))
        .drop("_block", "_pump_seen", "_dump_seen")
    )


def earliest_pairs(flagged: DataFrame, pair_window: str) -> DataFrame:
    """Each PUMP with its earliest later DUMP inside the pair window; DUMPs may be shared.

    One pass from late to early carries the nearest DUMP along, so no pair is
    formed that would be thrown away again.
    """
    seconds = interval_seconds(pair_window)
    slim = flagged.select(
        "symbol", "phase", "window_start", "window_end", "price_change_pct", "volume_ratio",
        "detected_at",
    )
    spread = spread_over_blocks(slim, "window_start", _block_seconds(seconds), lookahead=seconds)
    late_first = (
        Window.partitionBy("symbol", "_block")
        .orderBy(F.desc("window_start"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bar = F.struct(
        "window_start", "window_end", "price_change_pct", "volume_ratio", "detected_at"
    )
    next_dump = F.last(F.when(F.col("phase") == "DUMP", bar), ignorenulls=True).over(late_first)
    limit = F.col("window_start") + F.make_dt_interval(secs=F.lit(seconds))
    return (
        spread.withColumn("_dump", next_dump)
        .filter(
            F.col("_home")
            & (F.col("phase") == "PUMP")
            & (F.col("_dump.window_start") <= limit)
        )
        .select(
            "symbol",
            F.col("window_start").alias("pump_start"),
            F.col("window_end").alias("pump_end"),
            F.col("_dump.window_start").alias("dump_start"),
            F.col("_dump.window_end").alias("dump_end"),
            F.col("price_change_pct").alias("pump_price_chg_pct"),
            F.col("_dump.price_change_pct").alias("dump_price_chg_pct"),
            F.col("volume_ratio").alias("pump_vol_ratio"),
            F.col("_dump.volume_ratio").alias("dump_vol_ratio"),
            F.greatest("detected_at", "_dump.detected_at").alias("detected_at"),
        )
    )


def pair_report_columns(pairs: DataFrame) -> DataFrame:
    """Matched pairs with the columns an alert report expects."""
    return pairs.withColumns(
        {
            "window_start": F.col("pump_start"),
            "window_end": F.col("dump_end"),
            "phase": F.lit("PUMP→DUMP"),
            "alert_type": F.lit("PUMP_DUMP"),
            "severity": report_severity(F.col("pump_price_chg_pct"), F.col("pump_vol_ratio")),
        }
    )


def latest_bar_per_symbol(bars: DataFrame) -> DataFrame:
    """Newest bar of each symbol; older ones are dropped before the shuffle."""
    newest = Window.partitionBy("symbol").orderBy(F.desc("window_start"))
    return (
        bars.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def bars_since(bars: DataFrame, processed: DataFrame, symbol_bound: int | None = None) -> DataFrame:
    """Bars newer than the newest processed bar of their symbol.

    With a ``symbol_bound`` the bars have at most so many symbols; marks of
    other symbols are left out before they are broadcast.
    """
    if symbol_bound is not None:
        processed = processed.join(bars.select("symbol").distinct(), "symbol", "left_semi")
    mark = processed.groupBy("symbol").agg(F.max("window_start").alias("_mark"))
    return (
        bars.join(bounded_broadcast(mark, symbol_bound), "symbol", "left")
        .filter(F.col("_mark").isNull() | (F.col("window_start") > F.col("_mark")))
        .drop("_mark")
    )
