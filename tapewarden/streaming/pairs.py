"""Live PUMP to DUMP pairs as a stream-stream join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewarden.config import interval_seconds
from tapewarden.functions.timestamps import time_block


def pair_stream(pumps: DataFrame, dumps: DataFrame, pair_window: str, delay: str) -> DataFrame:
    """Join two streams of flagged bars on symbol and time; both sides age out of state.

    Besides the symbol the join has a time block as long as the pair window:
    a PUMP stands in its own block and the next, a DUMP in its own. So a busy
    symbol is spread over tasks by time, and a PUMP meets at most as many DUMPs
    as bars fit in the pair window.
    """
    seconds = interval_seconds(pair_window)
    own_block = time_block(F.col("window_start"), seconds)
    pump = pumps.select(
        "symbol",
        F.col("window_start").alias("pump_start"),
        F.col("price_change_pct").alias("pump_price_chg_pct"),
        F.explode(F.array(own_block, own_block + 1)).alias("_pump_block"),
    ).withWatermark("pump_start", delay)
    dump = dumps.select(
        F.col("symbol").alias("_symbol"),
        F.col("window_start").alias("dump_start"),
        F.col("price_change_pct").alias("dump_price_chg_pct"),
        own_block.alias("_dump_block"),
    ).withWatermark("dump_start", delay)
    limit = F.col("pump_start") + F.expr(f"INTERVAL {seconds} SECONDS")
    return pump.join(
        dump,
        (F.col("symbol") == F.col("_symbol"))
        & (F.col("_pump_block") == F.col("_dump_block"))
        & (F.col("dump_start") > F.col("pump_start"))
        & (F.col("dump_start") <= limit),
    ).drop("_symbol", "_pump_block", "_dump_block")
