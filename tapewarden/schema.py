"""Declared schemas and keys; nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_STRING, _DOUBLE, _LONG = T.StringType(), T.DoubleType(), T.LongType()
_INT, _BOOL, _TIME = T.IntegerType(), T.BooleanType(), T.TimestampType()


def _struct(*columns: tuple) -> T.StructType:
    """Columns are (name, type) or (name, type, nullable)."""
    return T.StructType([T.StructField(c[0], c[1], c[2] if len(c) > 2 else True) for c in columns])


TRADE = _struct(
    ("trade_id", _STRING),
    ("timestamp", _STRING),
    ("symbol", _STRING),
    ("price", _DOUBLE),
    ("quantity", _DOUBLE),
    ("side", _STRING),
    ("order_id", _STRING),
    ("event_type", _STRING),
    ("trader_id", _STRING),
)

# A trade whose numbers are still text, as validation wants them.
TEXT_TRADE = T.StructType([T.StructField(f.name, _STRING) for f in TRADE.fields])

REQUIRED_TRADE_FIELDS = tuple(name for name in TRADE.names if name != "trader_id")
DEAD_LETTER_COLUMNS = (*REQUIRED_TRADE_FIELDS, "rejection_reason", "rejected_at")
TRADE_KEY = ("symbol", "order_id")

_EXCHANGE_FIELDS = (
    ("T", _LONG), ("s", _STRING), ("p", _STRING), ("q", _STRING), ("m", _BOOL), ("a", _LONG),
)
# An exchange event comes bare or wrapped in {"stream", "data"}.
EXCHANGE_EVENT = _struct(
    ("stream", _STRING), ("data", _struct(*_EXCHANGE_FIELDS)), *_EXCHANGE_FIELDS
)

WASH_ALERT = _struct(
    ("window_start", _TIME, False),
    ("window_end", _TIME, False),
    ("symbol", _STRING, False),
    ("trade_count", _INT),
    ("total_volume", _DOUBLE),
    ("mean_volume", _DOUBLE),
    ("std_volume", _DOUBLE),
    ("z_score", _DOUBLE),
    ("severity", _STRING, False),
    ("alert_type", _STRING),
    ("detected_at", _TIME),
)

PUMP_DUMP_ALERT = _struct(
    ("window_start", _TIME, False),
    ("window_end", _TIME, False),
    ("symbol", _STRING, False),
    ("phase", _STRING, False),
    ("pump_price_chg_pct", _DOUBLE),
    ("dump_price_chg_pct", _DOUBLE),
    ("price_change_pct", _DOUBLE),
    ("volume_ratio", _DOUBLE),
    ("severity", _STRING, False),
    ("alert_type", _STRING),
    ("detected_at", _TIME),
)

WASH_SWEEP = _struct(
    ("window_start", _TIME, False),
    ("window_end", _TIME, False),
    ("symbol", _STRING, False),
    ("trade_count", _INT),
    ("total_volume", _DOUBLE),
    ("z_score", _DOUBLE),
    ("threshold", _DOUBLE, False),
    ("flagged", _BOOL, False),
    ("severity", _STRING),
    ("detected_at", _TIME),
)

PUMP_DUMP_SWEEP = _struct(
    ("window_start", _TIME, False),
    ("window_end", _TIME, False),
    ("symbol", _STRING, False),
    ("price_change_pct", _DOUBLE),
    ("volume_ratio", _DOUBLE),
    ("price_threshold", _DOUBLE, False),
    ("vol_threshold", _DOUBLE, False),
    ("phase", _STRING),
    ("flagged", _BOOL),
    ("severity", _STRING),
    ("detected_at", _TIME),
)


@dataclass(frozen=True)
class KeyedTable:
    """A table with a unique key; ``limits`` are the longest allowed texts."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    limits: tuple[tuple[str, int], ...]

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)


_ALERT_LIMITS = (("symbol", 20), ("severity", 10), ("alert_type", 20))

WASH_ALERTS = KeyedTable(
    "wash_alerts", WASH_ALERT, ("window_start", "window_end", "symbol"), _ALERT_LIMITS
)
PUMP_DUMP_ALERTS = KeyedTable(
    "pump_dump_alerts",
    PUMP_DUMP_ALERT,
    ("window_start", "symbol", "phase"),
    (*_ALERT_LIMITS, ("phase", 10)),
)
WASH_SENSITIVITY = KeyedTable(
    "wash_sensitivity",
    WASH_SWEEP,
    ("window_start", "window_end", "symbol", "threshold"),
    (("symbol", 20), ("severity", 10)),
)
PD_SENSITIVITY = KeyedTable(
    "pd_sensitivity",
    PUMP_DUMP_SWEEP,
    ("window_start", "symbol", "price_threshold", "vol_threshold", "phase"),
    (("symbol", 20), ("phase", 10), ("severity", 10)),
)
KEYED_TABLES = (WASH_ALERTS, PUMP_DUMP_ALERTS, WASH_SENSITIVITY, PD_SENSITIVITY)
