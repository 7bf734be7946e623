"""Keeping long per-symbol time series in many small tasks.

One symbol may hold a third of all bars, so nothing here sorts a symbol's
whole history in one task. Series are cut into fixed time blocks: totals and
neighbours that cross a border come from a small per-block frame, or from
context rows copied over the border.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewarden.functions.timestamps import time_block

DAY = 86_400
MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, row_bound: int | None) -> DataFrame:
    """Broadcast only under a proven row bound; else adaptive execution decides by size."""
    if row_bound is not None and row_bound <= MAX_BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def planned_alike(df: DataFrame) -> DataFrame:
    """Keep all columns of an aggregate in use, so that two readers of it share one shuffle.

    A frame joined with its own totals is planned twice. Column pruning would
    leave each side other aggregates and hence two scans of the raw trades.
    The condition is always true and mentions every column, so both sides stay
    equal and Spark runs scan and partial aggregate once (ReusedExchange).
    """
    return df.filter(F.xxhash64(*df.columns) >= F.lit(-(2**63)))


def block_number(time: Column, seconds: int) -> Column:
    """Time block, never null: a null test on one side of a join would set its plan apart."""
    return F.coalesce(time_block(time, seconds), F.lit(0))


def spread_over_blocks(
    df: DataFrame, time: str, seconds: int, lookback: int = 0, lookahead: int = 0
) -> DataFrame:
    """Assign rows to blocks, with context copies near the borders.

    A row within ``lookback`` seconds before a block joins it as context for
    rows that look back, one within ``lookahead`` seconds after its end for
    rows that look ahead. ``_home`` tells the original from the copies.
    """
    if max(lookback, lookahead) > seconds:
        raise ValueError("blocks must be at least as long as the context")
    at = F.col(time)
    first = time_block(at - F.make_dt_interval(secs=F.lit(lookahead)), seconds)
    last = time_block(at + F.make_dt_interval(secs=F.lit(lookback)), seconds)
    return df.withColumn("_block", F.explode(F.sequence(first, last))).withColumn(
        "_home", F.col("_block") == time_block(at, seconds)
    )


def trailing_totals(
    df: DataFrame, by: Sequence[str], time: str, value: str, seconds: int = DAY
) -> DataFrame:
    """Add ``_prior_count`` and ``_prior_sum`` of ``value`` over the earlier rows of ``by``.

    A running total inside each block, plus the total of the earlier blocks:
    only one row per key and block is ordered over the whole history.
    """
    key = [*by, "_block"]
    blocked = planned_alike(df).withColumn("_block", block_number(F.col(time), seconds))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.groupBy(*key)
        .agg(F.count(value).alias("_n"), F.sum(value).alias("_s"))
        .select(
            *key,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
            F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_s0"),
        )
    )
    inside = Window.partitionBy(*key).orderBy(time).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.join(carried, key)
        .withColumn("_prior_count", F.col("_n0") + F.count(value).over(inside))
        .withColumn("_prior_sum", F.col("_s0") + F.coalesce(F.sum(value).over(inside), F.lit(0.0)))
        .drop("_block", "_n0", "_s0")
    )
