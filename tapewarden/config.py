"""Detector settings, passed to the plans as one immutable value."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any

# Code sets, thresholds and grids that results depend on.
SYMBOLS = ("BTCUSDT", "ETHUSDT", "SOLUSDT")
SIDES = ("BUY", "SELL")
EVENT_TYPES = ("TRADE", "PUMP", "DUMP", "WASH")
TRADES_TOPIC = "market-trades"
WASH_ALERTS_TOPIC = "wash-alerts"
PD_ALERTS_TOPIC = "pump-dump-alerts"
WASH_GRID = (0.1, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0)
PD_GRID = ((0.0005, 0.5), (0.001, 0.8), (0.001, 1.1), (0.002, 1.5), (0.005, 2.0))
REPORT_POINT = (0.0005, 0.5)
GAP_SECONDS = 5
DISPLAY_ZONE = "Asia/Kolkata"
# Thresholds a detector falls back to when a setting is absent.
UNSET_FALLBACKS = {
    "wash_zscore_threshold": 1.8,
    "pd_pump_threshold": 0.01,
    "pd_dump_threshold": -0.01,
    "pd_volume_ratio": 1.5,
    "pd_window_minutes": 3,
}

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def interval_seconds(text: str) -> int:
    """Seconds of an interval such as ``"2 minutes"``."""
    count, unit = text.split()
    return int(count) * _UNIT_SECONDS[unit.removesuffix("s")]


@dataclass(frozen=True)
class DetectionConfig:
    """Settings of both detectors.

    ``symbols`` is the symbol dimension. It bounds the per-symbol frames, so
    they may be broadcast; ``None`` means any symbol and leaves those joins to
    adaptive execution.
    """

    symbols: tuple[str, ...] | None = SYMBOLS
    wash_window: str = "2 minutes"
    wash_threshold: float = 0.1
    wash_grid: tuple[float, ...] = WASH_GRID
    bar_width: str = "1 minute"
    pair_window: str = "5 minutes"
    pump_threshold: float = 0.001
    dump_threshold: float = -0.001
    volume_ratio: float = 1.1
    pd_grid: tuple[tuple[float, float], ...] = PD_GRID
    report_point: tuple[float, float] = REPORT_POINT

    def __post_init__(self) -> None:
        if self.pump_threshold <= 0 or self.dump_threshold >= 0:
            raise ValueError("need pump_threshold > 0 > dump_threshold: a bar has one phase")
        if any(price <= 0 for price, _ in (*self.pd_grid, self.report_point)):
            raise ValueError("grid price thresholds must be positive")
        for name in ("wash_window", "bar_width", "pair_window"):
            interval_seconds(getattr(self, name))

    @property
    def symbol_bound(self) -> int | None:
        return None if self.symbols is None else len(self.symbols)

    @classmethod
    def from_settings(cls, settings: Mapping[str, Any], **overrides: Any) -> DetectionConfig:
        """Build from a flat settings mapping; absent thresholds take the fallbacks."""
        value = {**UNSET_FALLBACKS, **settings}
        known = {f.name for f in fields(cls)}
        unknown = set(overrides) - known
        if unknown:
            raise TypeError(f"unknown settings: {sorted(unknown)}")
        base = {
            "wash_threshold": float(value["wash_zscore_threshold"]),
            "pump_threshold": float(value["pd_pump_threshold"]),
            "dump_threshold": float(value["pd_dump_threshold"]),
            "volume_ratio": float(value["pd_volume_ratio"]),
            "pair_window": f"{int(value['pd_window_minutes'])} minutes",
        }
        return cls(**{**base, **overrides})
