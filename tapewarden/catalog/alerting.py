"""Alert rows: normalising, checking, routing, storing, searching."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewarden.catalog import sample
from tapewarden.catalog.sample import AS_OF, CONFIG, checked, with_ctes
from tapewarden.config import DISPLAY_ZONE, PD_ALERTS_TOPIC, TRADES_TOPIC, WASH_ALERTS_TOPIC
from tapewarden.functions.timestamps import parse_iso_timestamp, to_display_zone
from tapewarden.operators import alerts as A
from tapewarden.plans.wash import alerts_from_scored, scored_windows, wash_sweep_rows
from tapewarden.schema import WASH_ALERTS, WASH_SENSITIVITY
from tapewarden.sinks.keyed import insert_ignore, read_inserted, read_upserted, upsert
from tapewarden.sinks.messages import encode_alerts, encode_trades
from tapewarden.sources.workspace import workspace

_KNOWN = ("click", "purchase", "view")
_LOOKBACK_MINUTES = 20_160


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


def alert_messages(spark, folder):
    """Messages of both alert topics, and trade messages that do not belong there."""
    strays = encode_trades(sample.trades(spark, folder)).withColumn("topic", F.lit(TRADES_TOPIC))
    return (
        encode_alerts(sample.wash(spark, folder), WASH_ALERTS_TOPIC)
        .unionByName(encode_alerts(sample.pump_dump(spark, folder), PD_ALERTS_TOPIC))
        .unionByName(strays)
    )


@checked
def all_alerts(spark, folder):
    return A.all_alerts(sample.wash(spark, folder), sample.pump_dump(spark, folder))


@checked
def query_alerts(spark, folder):
    return A.query_alerts(
        sample.wash(spark, folder), sample.pump_dump(spark, folder), severity="CRITICAL"
    )


@checked
def latest_alerts(spark, folder):
    return A.query_alerts(sample.wash(spark, folder), sample.pump_dump(spark, folder), limit=20)


@checked
def alerts_lookback(spark, folder):
    both = A.all_alerts(sample.wash(spark, folder), sample.pump_dump(spark, folder))
    return A.within_lookback(both, "detected_at", _LOOKBACK_MINUTES, _as_of())


@checked
def known_symbols_only(spark, folder):
    return A.known_symbols(sample.wash(spark, folder), _KNOWN)


@checked
def route_alerts(spark, folder):
    return A.route_alerts(alert_messages(spark, folder)).select("topic", "key", "target_table")


@checked
def critical_alerts(spark, folder):
    return A.critical_feed(sample.pump_dump(spark, folder))


@checked
def normalize_alerts(spark, folder):
    """Messages that use the z-score's alias and leave type and detection time out."""
    sent = (
        sample.wash(spark, folder)
        .withColumnRenamed("z_score", "zscore")
        .drop("alert_type", "detected_at")
    )
    messages = encode_alerts(sent, WASH_ALERTS_TOPIC)
    received = parse_iso_timestamp(F.col("window_end"))
    return A.decode_alerts(messages, WASH_ALERTS, received).drop("value")


@checked
def reject_bad_alerts(spark, folder):
    """Alerts of quiet windows sent without a severity, of falling volume with a long symbol."""
    wash = sample.wash(spark, folder)
    long_name = F.concat("symbol", F.lit("-quarterly-futures-contract"))
    spoiled = wash.withColumns(
        {
            "severity": F.when(F.col("severity") != "MEDIUM", F.col("severity")),
            "symbol": F.when(F.col("z_score") < 0, long_name).otherwise(F.col("symbol")),
        }
    )
    return (
        A.check_constraints(spoiled, WASH_ALERTS)
        .filter(F.col("constraint_error").isNotNull())
        .select("window_start", "symbol", "severity", "constraint_error")
    )


@checked
def display_zone(spark, folder):
    return to_display_zone(sample.wash(spark, folder), DISPLAY_ZONE)


@checked
def sink_insert_ignore(spark, folder):
    """Strong alerts stored first, then all alerts, then the second batch again."""
    root = workspace(spark, "insert-ignore")
    scored = scored_windows(sample.trades(spark, folder), CONFIG)
    early = alerts_from_scored(scored, 1.0, F.col("window_start"))
    late = alerts_from_scored(scored, CONFIG.wash_threshold, F.col("window_end"))
    for batch_id, rows in ((0, early), (1, late), (1, late)):
        insert_ignore(rows, root, WASH_ALERTS, batch_id)
    return read_inserted(spark, root, WASH_ALERTS).drop("event_date")


@checked
def sink_upsert(spark, folder):
    """Sweep rows stored, then the flagged ones once more, later and twice."""
    root = workspace(spark, "upsert")
    trades = sample.trades(spark, folder)
    first = wash_sweep_rows(trades, CONFIG, F.col("window_start"))
    second = wash_sweep_rows(trades, CONFIG, F.col("window_end")).filter("flagged")
    for batch_id, rows in ((0, first), (1, second), (1, second)):
        upsert(rows, root, WASH_SENSITIVITY, batch_id)
    return read_upserted(spark, root, WASH_SENSITIVITY).drop("event_date")


QUERIES = {
    "all_alerts": all_alerts,
    "query_alerts": query_alerts,
    "latest_alerts": latest_alerts,
    "alerts_lookback": alerts_lookback,
    "known_symbols_only": known_symbols_only,
    "route_alerts": route_alerts,
    "critical_alerts": critical_alerts,
    "normalize_alerts": normalize_alerts,
    "reject_bad_alerts": reject_bad_alerts,
    "to_display_zone": display_zone,
    "sink_insert_ignore": sink_insert_ignore,
    "sink_upsert": sink_upsert,
}

_WASH_COLUMNS = sample.WASH_SELECT.removeprefix("SELECT ").removesuffix(" FROM wash")
_BOTH = (
    sample.WASH_PATH + sample.BARS + sample.LOO + sample.phase_sql("loo") + sample.PUMP_DUMP
    + f""",
both_kinds AS (
  SELECT {_WASH_COLUMNS} FROM wash UNION ALL BY NAME SELECT * FROM pump_dump)"""
)


def _newest(limit: int | None = None, where: str = "TRUE") -> str:
    order = f"WHERE {where}"
    if limit is not None:
        order += f" ORDER BY detected_at DESC, window_start, symbol LIMIT {limit}"
    return (
        f"SELECT * FROM (SELECT {_WASH_COLUMNS} FROM wash {order}) "
        f"UNION ALL BY NAME SELECT * FROM (SELECT * FROM pump_dump {order})"
    )


_STAMP = "'%Y-%m-%dT%H:%M:%S.%f'"

ORACLES = {
    "all_alerts": with_ctes(_BOTH, "SELECT * FROM both_kinds"),
    "query_alerts": with_ctes(_BOTH, _newest(where="severity = 'CRITICAL'")),
    "latest_alerts": with_ctes(_BOTH, _newest(20)),
    "alerts_lookback": with_ctes(
        _BOTH,
        f"SELECT * FROM both_kinds WHERE detected_at >= TIMESTAMP '{AS_OF}' "
        f"- INTERVAL {_LOOKBACK_MINUTES} MINUTES",
    ),
    "known_symbols_only": with_ctes(
        sample.WASH_PATH,
        f"{sample.WASH_SELECT} WHERE symbol IN ({', '.join(repr(s) for s in _KNOWN)})",
    ),
    "route_alerts": with_ctes(
        _BOTH,
        f"SELECT '{WASH_ALERTS_TOPIC}' AS topic, symbol AS key, 'wash_alerts' AS target_table "
        f"FROM wash UNION ALL SELECT '{PD_ALERTS_TOPIC}', symbol, 'pump_dump_alerts' "
        f"FROM pump_dump UNION ALL SELECT '{TRADES_TOPIC}', symbol, NULL FROM trades",
    ),
    "critical_alerts": with_ctes(
        sample.PUMP_DUMP_PATH,
        f"""SELECT window_start, symbol, alert_type, severity,
  'CRITICAL ALERT: PUMP_DUMP on ' || symbol || ' — '
  || '{{"window_start":"' || strftime(window_start, {_STAMP}) || '","window_end":"'
  || strftime(window_end, {_STAMP}) || '","symbol":"' || symbol || '","phase":"DUMP'
  || '","pump_price_chg_pct":' || CAST(pump_price_chg_pct AS VARCHAR)
  || ',"dump_price_chg_pct":' || CAST(dump_price_chg_pct AS VARCHAR)
  || ',"price_change_pct":' || CAST(price_change_pct AS VARCHAR)
  || ',"volume_ratio":' || CAST(volume_ratio AS VARCHAR)
  || ',"severity":"CRITICAL","alert_type":"PUMP_DUMP","detected_at":"'
  || strftime(detected_at, {_STAMP}) || '"}}' AS message
FROM pump_dump WHERE severity = 'CRITICAL'""",
    ),
    "normalize_alerts": with_ctes(sample.WASH_PATH, sample.WASH_SELECT),
    "reject_bad_alerts": with_ctes(
        sample.WASH_PATH
        + """,
spoiled AS (
  SELECT window_start,
         CASE WHEN z_score < 0 THEN symbol || '-quarterly-futures-contract' ELSE symbol END
           AS symbol,
         CASE WHEN severity <> 'MEDIUM' THEN severity END AS severity
  FROM wash)""",
        "SELECT *, CASE WHEN severity IS NULL THEN 'null:severity' ELSE 'too_long:symbol' END "
        "AS constraint_error FROM spoiled WHERE severity IS NULL OR length(symbol) > 20",
    ),
    "to_display_zone": with_ctes(
        sample.WASH_PATH,
        f"SELECT * REPLACE (detected_at + INTERVAL 330 MINUTES AS detected_at) "
        f"FROM ({sample.WASH_SELECT})",
    ),
    "sink_insert_ignore": with_ctes(
        sample.WASH_PATH,
        f"""SELECT * REPLACE (
  CASE WHEN abs(z_score) > 1.0 THEN {sample.wash_severity_sql("1.0")} ELSE severity END
    AS severity,
  CASE WHEN abs(z_score) > 1.0 THEN window_start ELSE detected_at END AS detected_at)
FROM ({sample.WASH_SELECT})""",
    ),
    "sink_upsert": with_ctes(
        sample.TRADES + sample.WINDOWS + sample.SCORED,
        f"""SELECT window_start, window_end, symbol, CAST(trade_count AS INTEGER) AS trade_count,
  round(total_volume, 6) AS total_volume, round(z_score, 6) AS z_score, threshold,
  abs(z_score) > threshold AS flagged,
  CASE WHEN abs(z_score) > threshold THEN {sample.wash_severity_sql("threshold")} END AS severity,
  CASE WHEN abs(z_score) > threshold THEN window_end ELSE window_start END AS detected_at
FROM scored CROSS JOIN (VALUES {", ".join(f"(CAST({t} AS DOUBLE))" for t in CONFIG.wash_grid)})
  g(threshold)""",
    ),
}
