"""Windows, bars, baselines, detectors and sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewarden.catalog import sample
from tapewarden.catalog.sample import CONFIG, checked, with_ctes
from tapewarden.functions.severity import (
    pump_dump_severity,
    report_severity,
    sweep_severity,
    wash_severity,
)
from tapewarden.operators.baselines import volume_baseline, with_leave_one_out, with_trailing
from tapewarden.operators.sequences import (
    bars_since,
    candidate_pairs,
    classify_bars,
    flagged_at,
    latest_bar_per_symbol,
)
from tapewarden.operators.sweeps import pump_dump_sweep_summary, wash_sweep_summary
from tapewarden.operators.trades import clean_trades
from tapewarden.operators.windows import volume_windows
from tapewarden.plans.pump_dump import pump_dump_alerts, pump_dump_sweep_rows
from tapewarden.plans.wash import scored_windows, wash_sweep_rows

def _close():
    return F.col("window_end")


@checked
def wash_windows(spark, folder):
    return volume_windows(
        clean_trades(sample.trades(spark, folder), CONFIG.symbols), CONFIG.wash_window
    )


@checked
def volume_baselines(spark, folder):
    windows = volume_windows(
        clean_trades(sample.trades(spark, folder), CONFIG.symbols), CONFIG.wash_window
    )
    return volume_baseline(windows)


@checked
def wash_zscores(spark, folder):
    return scored_windows(sample.trades(spark, folder), CONFIG)


@checked
def wash_alerts(spark, folder):
    return sample.wash(spark, folder)


@checked
def wash_sweep(spark, folder):
    return wash_sweep_rows(sample.trades(spark, folder), CONFIG, _close())


@checked
def wash_summary(spark, folder):
    return wash_sweep_summary(wash_sweep_rows(sample.trades(spark, folder), CONFIG, _close()))


@checked
def ohlcv_bars(spark, folder):
    return sample.bars(spark, folder)


@checked
def volume_ratio_loo(spark, folder):
    return with_leave_one_out(sample.bars(spark, folder), CONFIG.symbol_bound)


@checked
def volume_ratio_trailing(spark, folder):
    return with_trailing(sample.bars(spark, folder))


@checked
def classified(spark, folder):
    rated = with_leave_one_out(sample.bars(spark, folder), CONFIG.symbol_bound)
    return classify_bars(rated, CONFIG)


@checked
def pump_dump(spark, folder):
    return sample.pump_dump(spark, folder)


@checked
def pump_dump_trailing(spark, folder):
    return pump_dump_alerts(sample.trades(spark, folder), CONFIG, "trailing", _close())


@checked
def pd_sweep(spark, folder):
    return pump_dump_sweep_rows(sample.trades(spark, folder), CONFIG, _close())


@checked
def pd_summary(spark, folder):
    return pump_dump_sweep_summary(
        pump_dump_sweep_rows(sample.trades(spark, folder), CONFIG, _close())
    )


@checked
def pump_dump_candidates(spark, folder):
    flagged = flagged_at(sample.report_sweep(spark, folder), CONFIG.report_point)
    return candidate_pairs(flagged, CONFIG.pair_window)


@checked
def pump_dump_pairs(spark, folder):
    return sample.pairs(spark, folder, limit=500)


@checked
def latest_bars(spark, folder):
    return latest_bar_per_symbol(sample.bars(spark, folder))


@checked
def new_bars_since(spark, folder):
    """Bars newer than the newest daily buy window of their symbol."""
    trades = sample.trades(spark, folder)
    processed = volume_windows(
        clean_trades(trades, CONFIG.symbols).filter(F.col("side") == "BUY"), "1 day"
    )
    return bars_since(sample.bars(spark, folder), processed, CONFIG.symbol_bound)


@checked
def severity_rules(spark, folder):
    """All four rules on every bar."""
    rated = with_leave_one_out(sample.bars(spark, folder), CONFIG.symbol_bound)
    change, ratio = F.col("price_change"), F.col("volume_ratio")
    return rated.filter(F.col("open_price") > 0).select(
        "symbol",
        "window_start",
        wash_severity(ratio - 1, CONFIG.wash_threshold).alias("wash_rule"),
        pump_dump_severity(change, CONFIG.dump_threshold).alias("alert_rule"),
        sweep_severity(change, 0.005).alias("sweep_rule"),
        report_severity(change * 100, ratio).alias("report_rule"),
    )


QUERIES = {
    "wash_alerts": wash_alerts,
    "wash_windows": wash_windows,
    "volume_baseline": volume_baselines,
    "wash_zscores": wash_zscores,
    "wash_sweep": wash_sweep,
    "wash_sweep_summary": wash_summary,
    "ohlcv_bars": ohlcv_bars,
    "volume_ratio_loo": volume_ratio_loo,
    "volume_ratio_trailing": volume_ratio_trailing,
    "classify_bars": classified,
    "pump_dump_alerts": pump_dump,
    "pump_dump_alerts_trailing": pump_dump_trailing,
    "pd_sweep": pd_sweep,
    "pd_sweep_summary": pd_summary,
    "pump_dump_candidates": pump_dump_candidates,
    "pump_dump_pairs": pump_dump_pairs,
    "latest_bar_per_symbol": latest_bars,
    "new_bars_since": new_bars_since,
    "severity_rules": severity_rules,
}

_WINDOW_COLUMNS = (
    "window_start, window_end, symbol, trade_count, round(total_volume, 6) AS total_volume, "
    "round(mean_volume, 6) AS mean_volume, round(std_volume, 6) AS std_volume"
)
_BAR_COLUMNS = (
    "window_start, window_end, symbol, round(open_price, 6) AS open_price, "
    "round(close_price, 6) AS close_price, round(high_price, 6) AS high_price, "
    "round(low_price, 6) AS low_price, round(total_volume, 6) AS total_volume, trade_count"
)
_RATED_COLUMNS = (
    f"{_BAR_COLUMNS}, round(baseline_volume, 6) AS baseline_volume, "
    "round(volume_ratio, 6) AS volume_ratio, round(price_change, 6) AS price_change"
)
_GRID = ", ".join(f"(CAST({t} AS DOUBLE))" for t in CONFIG.wash_grid)
_WASH_SWEEP = f""",
sweep AS (
  SELECT window_start, window_end, symbol, CAST(trade_count AS INTEGER) AS trade_count,
         round(total_volume, 6) AS total_volume, round(z_score, 6) AS z_score, threshold,
         abs(z_score) > threshold AS flagged,
         CASE WHEN abs(z_score) > threshold THEN {sample.wash_severity_sql("threshold")} END
           AS severity,
         window_end AS detected_at
  FROM scored CROSS JOIN (VALUES {_GRID}) g(threshold))"""

_TO_WINDOWS = sample.TRADES + sample.WINDOWS
_TO_SCORED = _TO_WINDOWS + sample.SCORED
_TO_BARS = sample.TRADES + sample.BARS
_TO_SWEEP = _TO_BARS + sample.TRAILING + sample.FULL_SWEEP

ORACLES = {
    "wash_alerts": with_ctes(sample.WASH_PATH, sample.WASH_SELECT),
    "wash_windows": with_ctes(_TO_WINDOWS, f"SELECT {_WINDOW_COLUMNS} FROM windows"),
    "volume_baseline": with_ctes(
        _TO_WINDOWS,
        "SELECT symbol, count(*) AS window_count, round(avg(total_volume), 6) AS baseline_mean, "
        "round(stddev_samp(total_volume), 6) AS baseline_std FROM windows GROUP BY symbol",
    ),
    "wash_zscores": with_ctes(
        _TO_SCORED, f"SELECT {_WINDOW_COLUMNS}, round(z_score, 6) AS z_score FROM scored"
    ),
    "wash_sweep": with_ctes(_TO_SCORED + _WASH_SWEEP, "SELECT * FROM sweep"),
    "wash_sweep_summary": with_ctes(
        _TO_SCORED + _WASH_SWEEP,
        "SELECT threshold AS z_threshold, count(*) AS total_windows, "
        "count(*) FILTER (WHERE flagged) AS alerts_fired, "
        "round(count(*) FILTER (WHERE flagged) * 100.0 / count(*), 4) AS alert_rate_pct "
        "FROM sweep GROUP BY threshold",
    ),
    "ohlcv_bars": with_ctes(_TO_BARS, f"SELECT {_BAR_COLUMNS} FROM bars"),
    "volume_ratio_loo": with_ctes(
        _TO_BARS + sample.LOO, f"SELECT {_RATED_COLUMNS} FROM loo"
    ),
    "volume_ratio_trailing": with_ctes(
        _TO_BARS + sample.TRAILING, f"SELECT {_RATED_COLUMNS} FROM rated"
    ),
    "classify_bars": with_ctes(
        _TO_BARS + sample.LOO + sample.phase_sql("loo"),
        f"SELECT {_RATED_COLUMNS}, phase FROM classified",
    ),
    "pump_dump_alerts": with_ctes(sample.PUMP_DUMP_PATH, "SELECT * FROM pump_dump"),
    "pump_dump_alerts_trailing": with_ctes(
        _TO_BARS + sample.TRAILING + sample.phase_sql("rated") + sample.PUMP_DUMP,
        "SELECT * FROM pump_dump",
    ),
    "pd_sweep": with_ctes(_TO_SWEEP, "SELECT * FROM sweep"),
    "pd_sweep_summary": with_ctes(
        _TO_SWEEP,
        "SELECT price_threshold, vol_threshold AS volume_ratio, "
        "count(DISTINCT (symbol, window_start)) AS total_bars, "
        "count(*) FILTER (WHERE flagged AND phase = 'PUMP') AS pumps_detected, "
        "count(*) FILTER (WHERE flagged AND phase = 'DUMP') AS dumps_detected, "
        "round(count(*) FILTER (WHERE flagged) * 100.0 "
        "/ count(DISTINCT (symbol, window_start)), 4) AS alert_rate_pct "
        "FROM sweep GROUP BY 1, 2",
    ),
    "pump_dump_candidates": with_ctes(
        _TO_BARS + sample.TRAILING + sample.REPORT_SWEEP + sample.CANDIDATES,
        "SELECT * FROM candidates",
    ),
    "pump_dump_pairs": with_ctes(
        sample.PAIRS_PATH, "SELECT * FROM pairs ORDER BY pump_start DESC, symbol LIMIT 500"
    ),
    "latest_bar_per_symbol": with_ctes(
        _TO_BARS,
        f"SELECT {_BAR_COLUMNS} FROM bars b WHERE window_start = "
        "(SELECT max(window_start) FROM bars m WHERE m.symbol = b.symbol)",
    ),
    "new_bars_since": with_ctes(
        _TO_BARS
        + """,
marks AS (
  SELECT symbol, max(date_trunc('day', event_time)) AS mark
  FROM clean WHERE side = 'BUY' GROUP BY symbol)""",
        f"SELECT {_BAR_COLUMNS.replace('symbol,', 'b.symbol AS symbol,')} "
        "FROM bars b LEFT JOIN marks m ON m.symbol = b.symbol "
        "WHERE mark IS NULL OR window_start > mark",
    ),
    "severity_rules": with_ctes(
        _TO_BARS + sample.LOO,
        """SELECT symbol, window_start,
  CASE WHEN abs(volume_ratio - 1) > 0.1 * 5 THEN 'CRITICAL'
       WHEN abs(volume_ratio - 1) > 0.1 * 2 THEN 'HIGH' ELSE 'MEDIUM' END AS wash_rule,
  CASE WHEN abs(price_change) > 0.001 * 5 THEN 'CRITICAL'
       WHEN abs(price_change) > 0.001 * 3 THEN 'HIGH' ELSE 'MEDIUM' END AS alert_rule,
  CASE WHEN abs(price_change) > 0.005 * 5 THEN 'CRITICAL'
       WHEN abs(price_change) > 0.005 * 2 THEN 'HIGH' ELSE 'MEDIUM' END AS sweep_rule,
  CASE WHEN abs(price_change * 100) > 0.15 OR volume_ratio > 3.0 THEN 'CRITICAL'
       WHEN abs(price_change * 100) > 0.08 OR volume_ratio > 1.5 THEN 'HIGH'
       ELSE 'MEDIUM' END AS report_rule
FROM loo WHERE open_price > 0""",
    ),
}
