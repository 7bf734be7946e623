"""Running ratings of closed windows and bars that go on from carried summaries.

Rows of one trigger are rated in time blocks. A block, and all that came before
a trigger, is a summary that merges with others: counts and sums, or count, mean
and squared deviation (Chan, Golub and LeVeque, 1983). Between triggers only one summary a symbol is
carried, so neither a back-fill nor a busy symbol is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewarden.config import DetectionConfig, interval_seconds
from tapewarden.operators.baselines import with_trailing
from tapewarden.operators.blocks import block_number, bounded_broadcast
from tapewarden.operators.sequences import consuming_matches, with_phases

#: Windows or bars of a symbol in one block.
BLOCK_ROWS = 512

#: `centre` is the first volume ever seen; `mean` and `deviation` are those of volumes less the centre.
SPREAD = "symbol string, centre double, seen bigint, mean double, deviation double"
#: Totals of all bars so far, the newest one's start, and the PUMP that a DUMP may still end.
BARS = (
    "symbol string, bars bigint, volume double, newest timestamp, "
    "pump struct<window_start: timestamp, price_change: double>"
)


def block_seconds(width: str) -> int:
    return BLOCK_ROWS * interval_seconds(width)


def _zero(column: Column | str) -> Column:
    return F.coalesce(column if isinstance(column, Column) else F.col(column), F.lit(0.0))


def _centred(windows: DataFrame, carried: DataFrame, symbol_bound: int | None) -> DataFrame:
    """Windows with the summary of their symbol before this trigger."""
    first = windows.groupBy("symbol").agg(F.min_by("total_volume", "window_start").alias("_first"))
    before = first.join(bounded_broadcast(carried, symbol_bound), "symbol", "left").select(
        "symbol",
        F.coalesce("centre", "_first").alias("_centre"),
        F.coalesce("seen", F.lit(0)).alias("_n0"),
        _zero("mean").alias("_mean0"),
        _zero("deviation").alias("_dev0"),
    )
    return windows.join(bounded_broadcast(before, symbol_bound), "symbol").withColumn(
        "_y", F.col("total_volume") - F.col("_centre")
    )


def _block_summaries(centred: DataFrame) -> DataFrame:
    """Count of each block, and its sums about the carried mean, which add up over blocks."""
    apart = F.col("_m") - F.col("_mean0")
    return (
        centred.groupBy("symbol", "_block")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.avg("_y").alias("_m"),
            F.var_pop("_y").alias("_v"),
            *[F.first(c).alias(c) for c in ("_centre", "_n0", "_mean0", "_dev0")],
        )
        .withColumn("_s1", F.col("_n") * apart)
        .withColumn("_s2", F.col("_n") * (F.col("_v") + apart * apart))
        .drop("_m", "_v")
    )


def _merged(n: Column, s1: Column, s2: Column) -> tuple[Column, Column, Column]:
    """Count, mean and squared deviation of what was carried and of blocks with these sums."""
    count = F.col("_n0") + n
    shift = F.when(count > 0, s1 / count).otherwise(0.0)
    deviation = F.greatest(F.col("_dev0") + s2 - shift * s1, F.lit(0.0))
    return count, F.col("_mean0") + shift, deviation


def running_zscores(
    windows: DataFrame, carried: DataFrame, seconds: int, symbol_bound: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Windows with `z_score` among those of their symbol up to and with them, and the summaries to carry on.

    Scores depend on the order of windows alone, not on how these are dealt to
    triggers. 0 for the first window of a symbol and where there is no spread.
    """
    centred = _centred(windows, carried, symbol_bound).withColumn("_block", block_number(F.col("window_start"), seconds))
    blocks = _block_summaries(centred)
    earlier = Window.partitionBy("symbol").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    count, mean, deviation = _merged(total("_n"), total("_s1"), total("_s2"))
    reached = blocks.select(
        "symbol", "_block", count.alias("_bn"), mean.alias("_bm"), deviation.alias("_bd")
    )
    inside = Window.partitionBy("symbol", "_block").orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    rated = (
        centred.join(reached, ["symbol", "_block"])
        .withColumns({"_n": F.count(F.lit(1)).over(inside), "_m": F.avg("_y").over(inside), "_v": F.var_pop("_y").over(inside)})
        .withColumns({"_all": F.col("_bn") + F.col("_n"), "_d": F.col("_m") - F.col("_bm")})
        .withColumns(
            {
                "_mean": F.col("_bm") + F.col("_d") * F.col("_n") / F.col("_all"),
                "_dev": F.col("_bd")
                + F.col("_n") * F.col("_v")
                + F.col("_d") * F.col("_d") * F.col("_bn") * F.col("_n") / F.col("_all"),
            }
        )
    )
    spread = F.when(F.col("_all") > 1, F.sqrt(F.col("_dev") / F.greatest(F.col("_all") - 1, F.lit(1))))
    z_score = F.when(spread > 0, (F.col("_y") - F.col("_mean")) / spread).otherwise(F.lit(0.0))
    scored = rated.select(*[F.col(c) for c in windows.columns], z_score.alias("z_score"))

    sums = blocks.groupBy("symbol", "_centre", "_n0", "_mean0", "_dev0").agg(
        *[F.sum(c).alias(c) for c in ("_n", "_s1", "_s2")]
    )
    count, mean, deviation = _merged(F.col("_n"), F.col("_s1"), F.col("_s2"))
    now = sums.select(
        "symbol", F.col("_centre").alias("centre"), count.alias("seen"), mean.alias("mean"), deviation.alias("deviation")
    )
    return scored, now.unionByName(carried.join(now, "symbol", "left_anti"))


def _newer(bars: DataFrame, carried: DataFrame, symbol_bound: int | None) -> DataFrame:
    mark = carried.select("symbol", F.col("newest").alias("_newest"))
    joined = bars.join(bounded_broadcast(mark, symbol_bound), "symbol", "left")
    return joined.filter(F.col("_newest").isNull() | (F.col("window_start") > F.col("_newest"))).drop("_newest")


def running_bars(bars: DataFrame, carried: DataFrame, config: DetectionConfig) -> DataFrame:
    """Bars that are newer than the carried ones, rated by all earlier bars of their symbol."""
    newer = _newer(bars, carried, config.symbol_bound)
    return with_trailing(newer, carried, config.symbol_bound, block_seconds(config.bar_width))


def running_matches(rated: DataFrame, carried: DataFrame, config: DetectionConfig) -> DataFrame:
    """Alert columns of the DUMPs that end a PUMP of these bars or the carried one."""
    columns = ("symbol", "window_start", "phase", "price_change", "volume_ratio")
    open_pumps = carried.filter(F.col("pump").isNotNull()).select(
        "symbol",
        "pump.window_start",
        F.lit("PUMP").alias("phase"),
        "pump.price_change",
        F.lit(None).cast("double").alias("volume_ratio"),
    )
    return consuming_matches(with_phases(rated, config).select(*columns).unionByName(open_pumps), config)


def carried_bars(rated: DataFrame, carried: DataFrame, config: DetectionConfig, horizon: Column) -> DataFrame:
    """The summaries after these bars; a PUMP is forgotten at `horizon` when that is two pair windows past its start.

    Of each symbol's marked bars the last counts: a PUMP stays open, a DUMP closes what was open.
    """
    marked = F.struct("window_start", "phase", "price_change")
    now = with_phases(rated, config).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"),
        F.sum("total_volume").alias("volume"),
        F.max("window_start").alias("newest"),
        F.max(F.when(F.col("phase").isNotNull(), marked)).alias("last"),
    )
    kept = F.when(
        F.col("pump").isNotNull(),
        F.struct(F.col("pump.window_start").alias("window_start"), F.lit("PUMP").alias("phase"), F.col("pump.price_change").alias("price_change")),
    )
    before = carried.select("symbol", "bars", "volume", "newest", kept.alias("last"))
    both = before.unionByName(now).groupBy("symbol").agg(
        F.sum("bars").alias("bars"), F.sum("volume").alias("volume"), F.max("newest").alias("newest"), F.max("last").alias("last")
    )
    alive = F.col("last.window_start") + F.make_dt_interval(secs=F.lit(2 * interval_seconds(config.pair_window))) > horizon
    pump = F.when((F.col("last.phase") == "PUMP") & alive, F.struct("last.window_start", "last.price_change"))
    return both.select("symbol", "bars", "volume", "newest", pump.alias("pump"))
