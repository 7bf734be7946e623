"""Feed gaps and back-fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewarden.operators.blocks import DAY, block_number, planned_alike
from tapewarden.operators.trades import dedup_trades
from tapewarden.functions.timestamps import time_block
from tapewarden.schema import TRADE_KEY

#: Seconds of the slots in which gaps are looked up.
SLOT = 60


def feed_gaps(
    trades: DataFrame, gap_seconds: int = 5, by: Sequence[str] = (), block_seconds: int = DAY
) -> DataFrame:
    """Spans of more than ``gap_seconds`` without a trade, feed-wide or per ``by`` columns.

    Trades are first reduced to the first and last time of each slot of
    ``gap_seconds``. A slot cannot hide a gap, so this loses nothing, and it
    is a partial aggregate: raw trades are neither shuffled nor sorted. The
    gap before a slot is then looked up inside its block, and across blocks
    from one row per block.
    """
    by = list(by)
    slots = (
        trades.filter(F.col("event_time").isNotNull())
        .groupBy(*by, time_block(F.col("event_time"), gap_seconds).alias("_slot"))
        .agg(F.min("event_time").alias("_first"), F.max("event_time").alias("_last"))
        .transform(planned_alike)
        .withColumn("_block", block_number(F.col("_first"), block_seconds))
    )
    block = [*by, "_block"]
    in_block = Window.partitionBy(*block).orderBy("_slot")
    # One row per block: a frame as long as the history has days.
    over_blocks = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_block")
    carried = (
        slots.groupBy(*block)
        .agg(F.max("_last").alias("_block_last"))
        .withColumn("_carried", F.lag("_block_last").over(over_blocks))
        .drop("_block_last")
    )
    start = F.coalesce(F.col("_previous"), F.col("_carried"))
    micros = F.unix_micros("gap_end") - F.unix_micros("gap_start")
    return (
        slots.withColumn("_previous", F.lag("_last").over(in_block))
        .join(carried, block)
        .select(*by, start.alias("gap_start"), F.col("_first").alias("gap_end"))
        .withColumn("gap_seconds", micros / 1_000_000)
        .filter(micros > gap_seconds * 1_000_000)
    )


def new_trades(
    fetched: DataFrame,
    seen: DataFrame,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """Fetched trades inside the bounds that were not seen, each once.

    ``seen`` may be the whole history, a back-fill is small next to it. The
    semi join first cuts the history to keys that were fetched: when those are
    small enough Spark broadcasts them and the history is not shuffled.
    """
    inside = fetched
    if start is not None:
        inside = inside.filter(F.col("event_time") >= start)
    if end is not None:
        inside = inside.filter(F.col("event_time") <= end)
    key = list(TRADE_KEY)
    known = seen.select(*key).join(inside.select(*key), key, "left_semi")
    return dedup_trades(inside).join(known, key, "left_anti")


def trades_in_gaps(
    fetched: DataFrame,
    gaps: DataFrame,
    by: Sequence[str] = (),
    block_seconds: int = DAY,
    slot_seconds: int = SLOT,
) -> DataFrame:
    """Fetched trades that lie in one of the gaps (both ends included).

    Gaps are looked up for slots of time, not for trades: a slot's gaps are
    those that begin in it and, as gaps of a feed do not overlap, the latest
    one before it. That one is found inside the slot's block of time, or carried over
    from earlier blocks by one row a block. A block has no more rows than slots, however many
    trades fall on a day, and the cost does not follow how long gaps are. Only slots that meet a gap
    are joined back to the trades, which are not sorted; the few slots are broadcast where
    adaptive execution finds them small.
    """
    by = list(by)
    gap = F.struct("gap_start", "gap_end")
    slot_of = lambda time: time_block(F.col(time), slot_seconds)
    traded = fetched.filter(F.col("event_time").isNotNull()).select(
        *by, slot_of("event_time").alias("_slot"), F.lit(None).cast("struct<gap_start: timestamp, gap_end: timestamp>").alias("_gap")
    )
    begun = gaps.select(*by, slot_of("gap_start").alias("_slot"), gap.alias("_gap"))
    slots = (
        traded.distinct()
        .unionByName(begun)
        .groupBy(*by, "_slot")
        .agg(F.max(F.col("_gap").isNull()).alias("_traded"), F.sort_array(F.collect_list("_gap")).alias("_begun"))
        .transform(planned_alike)
        .withColumn("_block", F.floor(F.col("_slot") * slot_seconds / block_seconds))
    )
    block = [*by, "_block"]
    last_begun = F.when(F.size("_begun") > 0, F.element_at("_begun", -1))
    before = Window.partitionBy(*block).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        Window.partitionBy(*(by or [F.lit(0)])).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per block that has trades or gaps.
    carried = (
        slots.groupBy(*block)
        .agg(F.max(last_begun).alias("_block_gap"))
        .withColumn("_carried", F.last("_block_gap", ignorenulls=True).over(earlier))
        .drop("_block_gap")
    )
    latest = F.coalesce(F.last(last_begun, ignorenulls=True).over(before), F.col("_carried"))
    reaches = time_block(F.col("_latest.gap_end"), slot_seconds) >= F.col("_slot")
    met = (
        slots.join(carried, block)
        .withColumn("_latest", latest)
        .withColumn("_gaps", F.when(reaches, F.concat(F.array("_latest"), "_begun")).otherwise(F.col("_begun")))
        .filter(F.col("_traded") & (F.size("_gaps") > 0))
        .select(*by, "_slot", "_gaps")
    )
    time = F.col("event_time")
    inside = F.exists("_gaps", lambda g: (time >= g["gap_start"]) & (time <= g["gap_end"]))
    return (
        fetched.withColumn("_slot", slot_of("event_time"))
        .join(met, [*by, "_slot"])
        .filter(inside)
        .select(*[F.col(f"`{c}`") for c in fetched.columns])
    )


def merge_backfill(history: DataFrame, backfill: DataFrame) -> DataFrame:
    """History plus the back-filled trades."""
    return history.unionByName(backfill, allowMissingColumns=True)


