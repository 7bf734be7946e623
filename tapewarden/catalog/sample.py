"""The events table as trades, and the SQL fragments the oracles share.

Events are sparse (about one per symbol and minute at the largest scale), so
windows are a day, bars an hour and the pair window five hours.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewarden.config import DetectionConfig
from tapewarden.functions.timestamps import as_utc_wall_time
from tapewarden.plans.pump_dump import (
    bars_from_trades,
    matched_pairs,
    pump_dump_alerts,
    report_point_sweep,
)
from tapewarden.plans.wash import wash_alerts
from tapewarden.sources.tables import read_events, trades_from_events

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = DetectionConfig(
    symbols=("click", "error", "purchase", "signup", "view"),
    wash_window="1 day",
    bar_width="1 hour",
    pair_window="5 hours",
)
AS_OF = "2024-01-31 00:00:00"
DIGITS = 6


def checked(build: Query) -> Query:
    """Run in UTC; round doubles and drop zones so that the result compares with SQL."""

    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return comparable(build(spark, folder))

    return run


def comparable(df: DataFrame) -> DataFrame:
    rounded = [
        F.round(F.col(f"`{name}`"), DIGITS).alias(name) if kind == "double" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ]
    return as_utc_wall_time(df.select(*rounded))


def trades(spark: SparkSession, folder: str) -> DataFrame:
    return trades_from_events(read_events(spark, folder))


def bars(spark: SparkSession, folder: str) -> DataFrame:
    return bars_from_trades(trades(spark, folder), CONFIG)


def wash(spark: SparkSession, folder: str) -> DataFrame:
    """Wash alerts, detected when their window closes."""
    return wash_alerts(trades(spark, folder), CONFIG, F.col("window_end"))


def pump_dump(spark: SparkSession, folder: str) -> DataFrame:
    """Pump-and-dump alerts, detected when the dump bar begins."""
    return pump_dump_alerts(trades(spark, folder), CONFIG, detected_at=F.col("window_end"))


def report_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return report_point_sweep(trades(spark, folder), CONFIG, F.col("window_end"))


def pairs(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """Matched pairs as reports use them."""
    return matched_pairs(report_sweep(spark, folder), CONFIG, limit=limit)


# --- SQL fragments: each is one or more CTEs that build on the earlier ones ---

_SYMBOL_LIST = ", ".join(f"'{s}'" for s in CONFIG.symbols)

TRADES = f"""
trades AS (
  SELECT CAST(event_id AS VARCHAR) AS trade_id, event_type AS symbol, value AS price,
         CAST(regexp_extract(props, '"k": *(-?[0-9.]+)', 1) AS DOUBLE) AS quantity,
         CASE WHEN user_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side,
         CAST(event_id AS VARCHAR) AS order_id, 'TRADE' AS event_type,
         CAST(user_id AS VARCHAR) AS trader_id, ts AS event_time
  FROM events),
clean AS (
  SELECT * FROM trades
  WHERE event_time IS NOT NULL AND quantity > 0 AND symbol IN ({_SYMBOL_LIST}))"""

WINDOWS = """,
windows AS (
  SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS window_start,
         CAST(date_trunc('day', event_time) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
         symbol, count(*) AS trade_count, sum(quantity) AS total_volume,
         avg(quantity) AS mean_volume, coalesce(stddev_samp(quantity), 0) AS std_volume
  FROM clean GROUP BY 1, 2, 3)"""

SCORED = """,
scored AS (
  SELECT w.*, CASE WHEN sd > 0 THEN (w.total_volume - mu) / sd ELSE 0.0 END AS z_score
  FROM windows w JOIN (
    SELECT symbol, avg(total_volume) AS mu, stddev_samp(total_volume) AS sd
    FROM windows GROUP BY symbol) b ON b.symbol = w.symbol)"""


def wash_severity_sql(threshold: str) -> str:
    return (
        f"CASE WHEN abs(z_score) > {threshold} * 5 THEN 'CRITICAL' "
        f"WHEN abs(z_score) > {threshold} * 2 THEN 'HIGH' ELSE 'MEDIUM' END"
    )


WASH = f""",
wash AS (
  SELECT window_start, window_end, symbol, CAST(trade_count AS INTEGER) AS trade_count,
         total_volume, mean_volume, std_volume, z_score,
         {wash_severity_sql("0.1")} AS severity, 'WASH_TRADE' AS alert_type,
         window_end AS detected_at
  FROM scored WHERE abs(z_score) > 0.1)"""

BARS = """,
bars AS (
  SELECT date_trunc('hour', event_time) AS window_start,
         date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end, symbol,
         arg_min(price, event_time) AS open_price, arg_max(price, event_time) AS close_price,
         max(price) AS high_price, min(price) AS low_price,
         sum(quantity) AS total_volume, count(*) AS trade_count
  FROM clean GROUP BY 1, 2, 3)"""

LOO = """,
loo AS (
  SELECT *, CASE WHEN baseline_volume > 0 THEN total_volume / baseline_volume ELSE 1.0 END
           AS volume_ratio,
         CASE WHEN open_price > 0 THEN (close_price - open_price) / open_price END AS price_change
  FROM (SELECT b.*, CASE WHEN n > 1 THEN (s - total_volume) / (n - 1) ELSE total_volume END
                 AS baseline_volume
        FROM bars b JOIN (SELECT symbol, count(*) AS n, sum(total_volume) AS s
                          FROM bars GROUP BY symbol) t ON t.symbol = b.symbol))"""

TRAILING = """,
rated AS (
  SELECT *, CASE WHEN baseline_volume > 0 THEN total_volume / baseline_volume ELSE 1.0 END
           AS volume_ratio,
         CASE WHEN open_price > 0 THEN (close_price - open_price) / open_price END AS price_change
  FROM (SELECT *, coalesce(avg(total_volume) OVER (
            PARTITION BY symbol ORDER BY window_start
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), total_volume) AS baseline_volume
        FROM bars))"""


def phase_sql(source: str) -> str:
    return f""",
classified AS (
  SELECT *, CASE WHEN price_change >= 0.001 AND volume_ratio >= 1.1 THEN 'PUMP'
                 WHEN price_change <= -0.001 AND volume_ratio >= 1.1 THEN 'DUMP' END AS phase
  FROM {source} WHERE open_price > 0)"""


# A DUMP whose nearest earlier PUMP-or-DUMP bar is a PUMP at most 5 hours back.
PUMP_DUMP = """,
pump_dump AS (
  SELECT prev_start AS window_start, window_start AS window_end, symbol, 'DUMP' AS phase,
         round(prev_change * 100, 4) AS pump_price_chg_pct,
         round(price_change * 100, 4) AS dump_price_chg_pct,
         round(price_change * 100, 4) AS price_change_pct,
         round(volume_ratio, 4) AS volume_ratio,
         CASE WHEN abs(price_change) > 0.001 * 5 THEN 'CRITICAL'
              WHEN abs(price_change) > 0.001 * 3 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
         'PUMP_DUMP' AS alert_type, window_start AS detected_at
  FROM (SELECT *, lag(phase) OVER w AS prev_phase, lag(window_start) OVER w AS prev_start,
               lag(price_change) OVER w AS prev_change
        FROM classified WHERE phase IS NOT NULL
        WINDOW w AS (PARTITION BY symbol ORDER BY window_start))
  WHERE phase = 'DUMP' AND prev_phase = 'PUMP'
    AND window_start <= prev_start + INTERVAL 5 HOURS)"""


def pd_sweep_sql(points: str) -> str:
    return f""",
sweep AS (
  SELECT window_start, window_end, symbol, round(price_change * 100, 6) AS price_change_pct,
         round(volume_ratio, 4) AS volume_ratio, price_threshold, vol_threshold, phase, flagged,
         CASE WHEN NOT flagged THEN NULL
              WHEN abs(price_change) > price_threshold * 5 THEN 'CRITICAL'
              WHEN abs(price_change) > price_threshold * 2 THEN 'HIGH'
              ELSE 'MEDIUM' END AS severity,
         window_end AS detected_at
  FROM (SELECT t.*, price_threshold, vol_threshold, phase,
               volume_ratio >= vol_threshold
               AND CASE WHEN phase = 'PUMP' THEN price_change >= price_threshold
                        ELSE price_change <= -price_threshold END AS flagged
        FROM rated t
        CROSS JOIN (VALUES {points}) p(price_threshold, vol_threshold)
        CROSS JOIN (VALUES ('PUMP'), ('DUMP')) f(phase)
        WHERE open_price > 0))"""


def _doubles(values: tuple[float, ...]) -> str:
    return "(" + ", ".join(f"CAST({v} AS DOUBLE)" for v in values) + ")"


REPORT_SWEEP = pd_sweep_sql(_doubles(CONFIG.report_point))
FULL_SWEEP = pd_sweep_sql(", ".join(_doubles(p) for p in CONFIG.pd_grid))

CANDIDATES = """,
candidates AS (
  SELECT p.symbol, p.window_start AS pump_start, p.window_end AS pump_end,
         d.window_start AS dump_start, d.window_end AS dump_end,
         p.price_change_pct AS pump_price_chg_pct, d.price_change_pct AS dump_price_chg_pct,
         p.volume_ratio AS pump_vol_ratio, d.volume_ratio AS dump_vol_ratio,
         greatest(p.detected_at, d.detected_at) AS detected_at
  FROM sweep p JOIN sweep d ON p.symbol = d.symbol AND d.window_start > p.window_start
   AND d.window_start <= p.window_start + INTERVAL 5 HOURS
  WHERE p.flagged AND p.phase = 'PUMP' AND d.flagged AND d.phase = 'DUMP')"""

PAIRS = (
    CANDIDATES
    + """,
pairs AS (
  SELECT * EXCLUDE (nth), pump_start AS window_start, dump_end AS window_end,
         'PUMP→DUMP' AS phase, 'PUMP_DUMP' AS alert_type,
         CASE WHEN abs(pump_price_chg_pct) > 0.15 OR pump_vol_ratio > 3.0 THEN 'CRITICAL'
              WHEN abs(pump_price_chg_pct) > 0.08 OR pump_vol_ratio > 1.5 THEN 'HIGH'
              ELSE 'MEDIUM' END AS severity
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol, pump_start ORDER BY dump_start) AS nth
        FROM candidates)
  WHERE nth = 1)"""
)

WASH_PATH = TRADES + WINDOWS + SCORED + WASH
PUMP_DUMP_PATH = TRADES + BARS + LOO + phase_sql("loo") + PUMP_DUMP
PAIRS_PATH = TRADES + BARS + TRAILING + REPORT_SWEEP + PAIRS
REPORT_PATH = TRADES + WINDOWS + SCORED + WASH + BARS + TRAILING + REPORT_SWEEP + PAIRS

_WASH_COLUMNS = (
    "window_start, window_end, symbol, trade_count, round(total_volume, 6) AS total_volume, "
    "round(mean_volume, 6) AS mean_volume, round(std_volume, 6) AS std_volume, "
    "round(z_score, 6) AS z_score, severity, alert_type, detected_at"
)
WASH_SELECT = f"SELECT {_WASH_COLUMNS} FROM wash"


def with_ctes(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"
