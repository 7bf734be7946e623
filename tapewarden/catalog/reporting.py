"""Report queries: wash alerts and matched pairs as an analyst sees them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewarden.catalog import sample
from tapewarden.catalog.sample import AS_OF, CONFIG, checked, with_ctes
from tapewarden.operators import alerts as A
from tapewarden.operators import reports as R
from tapewarden.plans.report import build_report


def _both(spark, folder):
    return sample.wash(spark, folder), sample.pairs(spark, folder)


def _labelled(spark, folder):
    wash, pairs = _both(spark, folder)
    columns = ["alert_type", "symbol", "severity", "detected_at"]
    return A.all_alerts(wash.select(*columns), pairs.select(*columns))


def _since():
    return F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(days=F.lit(14))


@checked
def severity_breakdown(spark, folder):
    return R.severity_breakdown(_labelled(spark, folder))


@checked
def avg_zscore_by_symbol(spark, folder):
    return R.average_zscore(sample.wash(spark, folder))


@checked
def alert_overview(spark, folder):
    return R.overview(*_both(spark, folder))


@checked
def alert_timeline(spark, folder):
    return R.timeline(*_both(spark, folder))


@checked
def symbol_risk(spark, folder):
    wash, pairs = _both(spark, folder)
    dimension = R.symbol_dimension(wash, (*CONFIG.symbols, "quiet"))
    return R.symbol_risk(wash, pairs, dimension)


@checked
def alert_date_range(spark, folder):
    return R.date_range(_labelled(spark, folder), F.col("detected_at") >= _since())


@checked
def recent_alert_counts(spark, folder):
    return R.recent_counts(_labelled(spark, folder), _since())


@checked
def flagged_symbols(spark, folder):
    return R.flagged_symbols(*_both(spark, folder))


@checked
def recent_wash_table(spark, folder):
    return R.recent_wash_table(sample.wash(spark, folder))


@checked
def pd_report_table(spark, folder):
    return R.pair_table(sample.pairs(spark, folder))


@checked
def pump_dump_points(spark, folder):
    return R.pair_points(sample.pairs(spark, folder))


def _filtered(spark, folder):
    """Report of one symbol over the last fortnight, all panels on the same two inputs."""
    return build_report(
        sample.wash(spark, folder),
        sample.report_sweep(spark, folder),
        CONFIG,
        symbol="purchase",
        lookback_minutes=20_160,
        as_of=F.lit(AS_OF).cast("timestamp"),
    ).panels()


@checked
def report_overview(spark, folder):
    return _filtered(spark, folder)["overview"]


@checked
def report_timeline(spark, folder):
    return _filtered(spark, folder)["timeline"]


def _everything(spark, folder):
    """Report without filters: all alerts and all pairs."""
    return build_report(sample.wash(spark, folder), sample.report_sweep(spark, folder), CONFIG).panels()


@checked
def full_report_overview(spark, folder):
    return _everything(spark, folder)["overview"]


@checked
def full_report_timeline(spark, folder):
    return _everything(spark, folder)["timeline"]


@checked
def full_report_risk(spark, folder):
    return _everything(spark, folder)["symbol_risk"]


@checked
def full_report_severity(spark, folder):
    panels = _everything(spark, folder)
    kinds = {"WASH_TRADE": "wash_severity", "PUMP_DUMP": "pair_severity"}
    parts = [panels[panel].withColumn("kind", F.lit(kind)) for kind, panel in kinds.items()]
    return parts[0].select("kind", "severity", "alerts").unionByName(
        parts[1].select("kind", "severity", "alerts")
    )


QUERIES = {
    "full_report_overview": full_report_overview,
    "full_report_timeline": full_report_timeline,
    "full_report_risk": full_report_risk,
    "full_report_severity": full_report_severity,
    "report_overview": report_overview,
    "report_timeline": report_timeline,
    "severity_breakdown": severity_breakdown,
    "avg_zscore_by_symbol": avg_zscore_by_symbol,
    "alert_overview": alert_overview,
    "alert_timeline": alert_timeline,
    "symbol_risk": symbol_risk,
    "alert_date_range": alert_date_range,
    "recent_alert_counts": recent_alert_counts,
    "flagged_symbols": flagged_symbols,
    "recent_wash_table": recent_wash_table,
    "pd_report_table": pd_report_table,
    "pump_dump_points": pump_dump_points,
}

_LABELLED = (
    sample.REPORT_PATH
    + """,
labelled AS (
  SELECT 'WASH_TRADE' AS alert_type, 'wash' AS kind, symbol, severity, detected_at FROM wash
  UNION ALL
  SELECT 'PUMP_DUMP', 'pump_dump', symbol, severity, detected_at FROM pairs)"""
)
_SINCE = f"TIMESTAMP '{AS_OF}' - INTERVAL 14 DAYS"
_DIMENSION = ", ".join(f"('{s}')" for s in (*CONFIG.symbols, "quiet"))

_FILTERED = (
    sample.TRADES + sample.WINDOWS + sample.SCORED + sample.WASH.replace("wash AS", "every_wash AS")
    + sample.BARS + sample.TRAILING + sample.REPORT_SWEEP.replace("sweep AS", "every_sweep AS")
    + f""",
sweep AS (SELECT * FROM every_sweep WHERE window_start >= {_SINCE})"""
    + sample.PAIRS.replace("pairs AS", "every_pair AS")
    + f""",
wash AS (
  SELECT * REPLACE (detected_at + INTERVAL 330 MINUTES AS detected_at) FROM every_wash
  WHERE symbol = 'purchase' AND detected_at >= {_SINCE}),
pairs AS (SELECT * FROM every_pair WHERE symbol = 'purchase'),
labelled AS (
  SELECT 'wash' AS kind, symbol, severity FROM wash
  UNION ALL SELECT 'pump_dump', symbol, severity FROM pairs)"""
)

_OVERVIEW = (
    "SELECT count(*) AS total_alerts, count(*) FILTER (WHERE kind = 'wash') AS wash_alerts, "
    "count(*) FILTER (WHERE kind = 'pump_dump') AS pump_dump_alerts, "
    "count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alerts, "
    "count(DISTINCT symbol) AS symbols_flagged FROM labelled"
)


def _risk(symbols: str) -> str:
    return (
        "SELECT s.symbol AS symbol, count(*) FILTER (WHERE kind = 'wash') AS wash_alerts, "
        "count(*) FILTER (WHERE kind = 'pump_dump') AS pump_dump_alerts, "
        "count(*) FILTER (WHERE severity = 'CRITICAL') AS critical, "
        "CAST(sum(CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 1 "
        "ELSE 0 END) AS BIGINT) AS risk_score "
        f"FROM (VALUES {symbols}) s(symbol) LEFT JOIN labelled l ON l.symbol = s.symbol "
        "GROUP BY s.symbol"
    )


ORACLES = {
    "full_report_overview": with_ctes(_LABELLED, _OVERVIEW),
    "full_report_timeline": with_ctes(
        sample.REPORT_PATH,
        "SELECT date_trunc('minute', placed_at) AS minute, alert_type, count(*) AS alerts FROM ("
        "SELECT detected_at + INTERVAL 330 MINUTES AS placed_at, 'Wash Trade' AS alert_type "
        "FROM wash UNION ALL SELECT window_start, 'Pump & Dump' FROM pairs) GROUP BY 1, 2",
    ),
    "full_report_risk": with_ctes(_LABELLED, _risk(", ".join(f"('{s}')" for s in CONFIG.symbols))),
    "full_report_severity": with_ctes(
        _LABELLED, "SELECT alert_type AS kind, severity, count(*) AS alerts FROM labelled GROUP BY 1, 2"
    ),
    "severity_breakdown": with_ctes(
        _LABELLED, "SELECT alert_type, severity, count(*) AS alerts FROM labelled GROUP BY 1, 2"
    ),
    "avg_zscore_by_symbol": with_ctes(
        sample.WASH_PATH,
        "SELECT symbol, round(avg(z_score), 6) AS avg_z_score FROM wash GROUP BY symbol",
    ),
    "alert_overview": with_ctes(
        _LABELLED,
        _OVERVIEW,
    ),
    "report_overview": with_ctes(
        _FILTERED,
        _OVERVIEW,
    ),
    "report_timeline": with_ctes(
        _FILTERED,
        "SELECT date_trunc('minute', placed_at) AS minute, alert_type, count(*) AS alerts FROM ("
        "SELECT detected_at AS placed_at, 'Wash Trade' AS alert_type FROM wash UNION ALL "
        "SELECT window_start, 'Pump & Dump' FROM pairs) GROUP BY 1, 2",
    ),
    "alert_timeline": with_ctes(
        sample.REPORT_PATH,
        "SELECT date_trunc('minute', placed_at) AS minute, alert_type, count(*) AS alerts FROM ("
        "SELECT detected_at AS placed_at, 'Wash Trade' AS alert_type FROM wash UNION ALL "
        "SELECT window_start, 'Pump & Dump' FROM pairs) GROUP BY 1, 2",
    ),
    "symbol_risk": with_ctes(_LABELLED, _risk(_DIMENSION)),
    "alert_date_range": with_ctes(
        _LABELLED,
        "SELECT alert_type, min(detected_at) AS first_detected, max(detected_at) "
        "AS last_detected, count(*) AS raw_count, "
        f"count(*) FILTER (WHERE detected_at >= {_SINCE}) AS filtered_count "
        "FROM labelled GROUP BY alert_type",
    ),
    "recent_alert_counts": with_ctes(
        _LABELLED,
        f"SELECT alert_type, count(*) AS alerts FROM labelled WHERE detected_at > {_SINCE} "
        "GROUP BY alert_type",
    ),
    "flagged_symbols": with_ctes(_LABELLED, "SELECT DISTINCT symbol FROM labelled"),
    "recent_wash_table": with_ctes(
        sample.WASH_PATH,
        "SELECT detected_at, symbol, severity, round(z_score, 6) AS z_score, "
        "round(total_volume, 6) AS total_volume, round(mean_volume, 6) AS mean_volume, "
        "trade_count, window_start, window_end FROM wash "
        "ORDER BY detected_at DESC, symbol LIMIT 50",
    ),
    "pd_report_table": with_ctes(
        sample.PAIRS_PATH
        + """,
exact AS (
  SELECT *, CAST(CAST(pump_price_chg_pct AS DECIMAL(18, 6)) AS DECIMAL(18, 4)) AS pump_pct,
         CAST(CAST(dump_price_chg_pct AS DECIMAL(18, 6)) AS DECIMAL(18, 4)) AS dump_pct,
         CAST(CAST(pump_vol_ratio AS DECIMAL(18, 4)) AS DECIMAL(18, 2)) AS pump_vol,
         CAST(CAST(dump_vol_ratio AS DECIMAL(18, 4)) AS DECIMAL(18, 2)) AS dump_vol
  FROM pairs)""",
        """SELECT detected_at, symbol, severity, CAST(pump_pct AS VARCHAR) || '%' AS "Pump %",
  CAST(dump_pct AS VARCHAR) || '%' AS "Dump %", CAST(pump_vol AS VARCHAR) || '×' AS "Pump Vol×",
  CAST(dump_vol AS VARCHAR) || '×' AS "Dump Vol×", pump_start AS "Pump Time",
  dump_start AS "Dump Time"
FROM exact ORDER BY detected_at DESC, symbol, pump_start LIMIT 50""",
    ),
    "pump_dump_points": with_ctes(
        sample.PAIRS_PATH,
        "SELECT symbol, detected_at, severity, pump_price_chg_pct, dump_price_chg_pct FROM pairs",
    ),
}
