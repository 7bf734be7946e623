"""Price change, volume ratio and bar phase."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def price_change(open_price: Column, close_price: Column) -> Column:
    """Relative change; null where the open price is not positive."""
    return F.when(open_price > 0, (close_price - open_price) / open_price)


def guarded_ratio(volume: Column, baseline: Column) -> Column:
    """``volume / baseline``, 1.0 where there is no positive baseline."""
    return F.when(baseline > 0, volume / baseline).otherwise(F.lit(1.0))


def bar_phase(
    change: Column,
    ratio: Column,
    pump_threshold: Column | float,
    dump_threshold: Column | float,
    volume_ratio: Column | float,
) -> Column:
    """PUMP, DUMP or null; both bounds are inclusive."""
    loud = ratio >= volume_ratio
    return F.when((change >= pump_threshold) & loud, "PUMP").when(
        (change <= dump_threshold) & loud, "DUMP"
    )


def percent(change: Column, digits: int) -> Column:
    return F.round(change * 100, digits)
