"""The four severity rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def banded(value: Column, base: Column | float, high: float, critical: float) -> Column:
    """CRITICAL above ``critical`` x base, HIGH above ``high`` x base, else MEDIUM."""
    base = base if isinstance(base, Column) else F.lit(base)
    return (
        F.when(value > base * critical, "CRITICAL")
        .when(value > base * high, "HIGH")
        .otherwise("MEDIUM")
    )


def wash_severity(z_score: Column, threshold: Column | float) -> Column:
    return banded(F.abs(z_score), threshold, high=2.0, critical=5.0)


def pump_dump_severity(dump_change: Column, dump_threshold: float) -> Column:
    return banded(F.abs(dump_change), abs(dump_threshold), high=3.0, critical=5.0)


def sweep_severity(price_change: Column, price_threshold: Column | float) -> Column:
    """The price sweep calls HIGH from 2x, unlike the alert rule's 3x."""
    return banded(F.abs(price_change), price_threshold, high=2.0, critical=5.0)


def report_severity(pump_pct: Column, pump_volume_ratio: Column) -> Column:
    """Rule of the matched-pair report; ``pump_pct`` is in percent."""
    size = F.abs(pump_pct)
    return (
        F.when((size > 0.15) | (pump_volume_ratio > 3.0), "CRITICAL")
        .when((size > 0.08) | (pump_volume_ratio > 1.5), "HIGH")
        .otherwise("MEDIUM")
    )
