"""Sources, validation, messages, gaps and back-fill."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewarden.catalog import sample
from tapewarden.catalog.sample import AS_OF, CONFIG, checked, with_ctes
from tapewarden.config import PD_ALERTS_TOPIC, WASH_ALERTS_TOPIC
from tapewarden.functions.costly import with_once
from tapewarden.functions.timestamps import iso_text
from tapewarden.operators.gaps import feed_gaps, new_trades
from tapewarden.operators.trades import (
    clean_trades,
    ingest_quality,
    rejected_only,
    rejections_by_reason,
    valid_only,
    validate_trades,
    with_event_time,
)
from tapewarden.plans.ingest import ingest_trades, repair_gaps
from tapewarden.sinks.messages import encode_alerts, encode_trades
from tapewarden.sources.exchange import decode_trades, normalize_exchange_events
from tapewarden.sources.tables import event_quantity, read_events


def spoiled_trades(events):
    """Every event as a text trade, some fields spoiled depending on ``props.k``.

    The given tables hold no malformed trades; the low values of ``k`` stand
    for one kind of damage (or one time format) each.
    """
    events = with_once(events, "_k", event_quantity().cast("int"))
    k = F.col("_k")

    def spoil(good, **cases):
        column = good
        for name, bad in cases.items():
            column = F.when(k == int(name[1:]), bad).otherwise(column)
        return column

    text = F.lit(None).cast("string")
    price = F.col("value").cast("string")
    side = F.when(F.col("user_id") % 2 == 0, "BUY").otherwise("SELL")
    return events.select(
        F.col("event_id").cast("string").alias("trade_id"),
        spoil(
            iso_text(F.col("ts").cast("timestamp")),
            k5=F.lit("2024-13-01T00:00:00"),
            k6=F.lit("yesterday"),
            k12=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            k13=F.date_format("ts", "yyyy-MM-dd"),
            k14=F.date_format("ts", "yyyyMMdd'T'HHmmss"),
            k15=F.date_format("ts", "yyyy-MM-dd HH:mm:ss'+05:30'"),
        ).alias("timestamp"),
        spoil(F.col("event_type"), k1=F.lit("  "), k9=F.lit("DOGE")).alias("symbol"),
        spoil(price, k2=F.concat(F.lit("-"), price), k3=F.lit("n/a")).alias("price"),
        spoil(k.cast("string"), k4=F.lit(""), k11=F.lit("1e")).alias("quantity"),
        spoil(side, k7=F.lit("HOLD")).alias("side"),
        spoil(F.col("event_id").cast("string"), k10=text).alias("order_id"),
        spoil(F.lit("TRADE"), k8=F.lit("CANCEL")).alias("event_type"),
        F.col("user_id").cast("string").alias("trader_id"),
    )


def _validated(spark, folder):
    return validate_trades(spoiled_trades(read_events(spark, folder)), CONFIG.symbols)


def raw_messages(trades):
    """Trades as raw exchange JSON: buys inside the stream envelope, sells bare."""
    event = F.struct(
        F.unix_millis("event_time").alias("T"),
        F.col("symbol").alias("s"),
        F.col("price").cast("string").alias("p"),
        F.col("quantity").cast("string").alias("q"),
        (F.col("side") == "SELL").alias("m"),
        F.col("order_id").cast("long").alias("a"),
    )
    wrapped = F.to_json(F.struct(F.lit("trades").alias("stream"), event.alias("data")))
    return trades.select(
        F.when(F.col("side") == "BUY", wrapped).otherwise(F.to_json(event)).alias("value")
    )


def _timed(spark, folder):
    return sample.trades(spark, folder).withColumn("timestamp", iso_text(F.col("event_time")))


@checked
def validated(spark, folder):
    return _validated(spark, folder).select("trade_id", "rejection_reason")


@checked
def valid_trades(spark, folder):
    return valid_only(_validated(spark, folder)).drop("timestamp")


@checked
def dead_letter_rows(spark, folder):
    return rejected_only(_validated(spark, folder), F.lit(AS_OF).cast("timestamp"))


@checked
def quality(spark, folder):
    return ingest_quality(_validated(spark, folder))


@checked
def reasons(spark, folder):
    return rejections_by_reason(_validated(spark, folder))


@checked
def cleaned(spark, folder):
    return clean_trades(sample.trades(spark, folder), CONFIG.symbols)


@checked
def parse_timestamps(spark, folder):
    return with_event_time(spoiled_trades(read_events(spark, folder))).select(
        "trade_id", "event_time"
    )


@checked
def normalize_raw_trades(spark, folder):
    trades = normalize_exchange_events(raw_messages(sample.trades(spark, folder)))
    return trades.withColumns(
        {"price": F.col("price").cast("double"), "quantity": F.col("quantity").cast("double")}
    )


@checked
def ingested(spark, folder):
    raw = raw_messages(sample.trades(spark, folder))
    valid, _ = ingest_trades(raw.union(raw), CONFIG.symbols)
    return valid.drop("timestamp")


@checked
def encode_trade_messages(spark, folder):
    return encode_trades(sample.trades(spark, folder))


@checked
def json_decode_trades(spark, folder):
    return decode_trades(encode_trades(sample.trades(spark, folder))).drop("timestamp")


@checked
def encode_alert_messages(spark, folder):
    wash = sample.wash(spark, folder)
    rounded = wash.withColumns(
        {c: F.round(c, 4) for c in ("total_volume", "mean_volume", "std_volume", "z_score")}
    )
    return encode_alerts(rounded, WASH_ALERTS_TOPIC).unionByName(
        encode_alerts(sample.pump_dump(spark, folder), PD_ALERTS_TOPIC)
    )


@checked
def gaps(spark, folder):
    return feed_gaps(sample.trades(spark, folder))


@checked
def gaps_by_symbol(spark, folder):
    return feed_gaps(sample.trades(spark, folder), gap_seconds=600, by=["symbol"])


@checked
def backfill_new_trades(spark, folder):
    """Pages fetched twice over a gap, against a history that holds the buys only."""
    trades = sample.trades(spark, folder)
    return new_trades(
        trades.union(trades),
        trades.filter(F.col("side") == "BUY"),
        F.lit("2024-01-05 00:00:00").cast("timestamp"),
        F.lit("2024-01-25 00:00:00").cast("timestamp"),
    )


@checked
def merged_backfill(spark, folder):
    """Gaps of over ten minutes in the buys, filled from all valid trades."""
    trades = _timed(spark, folder)
    history = trades.filter(F.col("side") == "BUY")
    return repair_gaps(history, trades, CONFIG.symbols, gap_seconds=600).drop("timestamp")


QUERIES = {
    "normalize_raw_trades": normalize_raw_trades,
    "json_decode_trades": json_decode_trades,
    "encode_trade_messages": encode_trade_messages,
    "encode_alert_messages": encode_alert_messages,
    "parse_timestamps": parse_timestamps,
    "validate_trades": validated,
    "valid_trades": valid_trades,
    "dead_letter_rows": dead_letter_rows,
    "ingest_quality": quality,
    "rejections_by_reason": reasons,
    "clean_trades": cleaned,
    "ingest_trades": ingested,
    "feed_gaps": gaps,
    "feed_gaps_by_symbol": gaps_by_symbol,
    "backfill_new_trades": backfill_new_trades,
    "merge_backfill": merged_backfill,
}

_SPOILED = f""",
spoiled AS (
  SELECT trade_id, price AS num_price, quantity AS k, event_time AS ts,
         CASE quantity WHEN 5 THEN '2024-13-01T00:00:00' WHEN 6 THEN 'yesterday'
           WHEN 12 THEN strftime(event_time, '%Y-%m-%dT%H:%M:%SZ')
           WHEN 13 THEN strftime(event_time, '%Y-%m-%d')
           WHEN 14 THEN strftime(event_time, '%Y%m%dT%H%M%S')
           WHEN 15 THEN strftime(event_time, '%Y-%m-%d %H:%M:%S+05:30')
           ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
         CASE quantity WHEN 1 THEN '  ' WHEN 9 THEN 'DOGE' ELSE symbol END AS symbol,
         CASE quantity WHEN 2 THEN '-' || CAST(price AS VARCHAR) WHEN 3 THEN 'n/a'
           ELSE CAST(price AS VARCHAR) END AS price,
         CASE quantity WHEN 4 THEN '' WHEN 11 THEN '1e'
           ELSE CAST(CAST(quantity AS INTEGER) AS VARCHAR) END AS quantity,
         CASE quantity WHEN 7 THEN 'HOLD' ELSE side END AS side,
         CASE quantity WHEN 10 THEN NULL ELSE order_id END AS order_id,
         CASE quantity WHEN 8 THEN 'CANCEL' ELSE 'TRADE' END AS event_type, trader_id
  FROM trades),
parsed AS (
  SELECT *, CASE WHEN k IN (5, 6) THEN NULL
                 WHEN k IN (12, 14) THEN date_trunc('second', ts)
                 WHEN k = 13 THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
                 WHEN k = 15 THEN date_trunc('second', ts) - INTERVAL 330 MINUTES
                 ELSE ts END AS event_time
  FROM spoiled),
validated AS (
  SELECT *, CASE
    WHEN trim(symbol) = '' THEN 'missing_field:symbol'
    WHEN quantity = '' THEN 'missing_field:quantity'
    WHEN order_id IS NULL THEN 'missing_field:order_id'
    WHEN TRY_CAST(price AS DOUBLE) IS NULL THEN 'invalid_price:' || price
    WHEN TRY_CAST(price AS DOUBLE) <= 0
      THEN 'non_positive_price:' || CAST(CAST(price AS DOUBLE) AS VARCHAR)
    WHEN TRY_CAST(quantity AS DOUBLE) IS NULL THEN 'invalid_quantity:' || quantity
    WHEN TRY_CAST(quantity AS DOUBLE) <= 0
      THEN 'non_positive_quantity:' || CAST(CAST(quantity AS DOUBLE) AS VARCHAR)
    WHEN event_time IS NULL THEN 'invalid_timestamp:' || "timestamp"
    WHEN side NOT IN ('BUY', 'SELL') THEN 'invalid_side:' || side
    WHEN event_type NOT IN ('TRADE', 'PUMP', 'DUMP', 'WASH')
      THEN 'invalid_event_type:' || event_type
    WHEN symbol NOT IN ({", ".join(f"'{s}'" for s in CONFIG.symbols)})
      THEN 'unknown_symbol:' || symbol
    END AS rejection_reason
  FROM parsed)"""
_TO_VALIDATED = sample.TRADES + _SPOILED
_TRADE_COLUMNS = (
    "trade_id, symbol, round(price, 6) AS price, round(quantity, 6) AS quantity, side, order_id, "
    "event_type, trader_id, event_time"
)
_STAMP = "'%Y-%m-%dT%H:%M:%S.%f'"


def _gap_sql(source: str, seconds: int, partition: str = "") -> str:
    columns = "symbol, " if partition else ""
    return f"""SELECT {columns}gap_start, gap_end,
  (epoch_us(gap_end) - epoch_us(gap_start)) / 1000000.0 AS gap_seconds
FROM (SELECT *, event_time AS gap_end,
             lag(event_time) OVER ({partition} ORDER BY event_time) AS gap_start FROM {source})
WHERE gap_end > gap_start + INTERVAL {seconds} SECONDS"""


ORACLES = {
    "normalize_raw_trades": with_ctes(
        sample.TRADES,
        "SELECT trade_id, strftime(date_trunc('millisecond', event_time), "
        f"{_STAMP}) AS \"timestamp\", symbol, round(price, 6) AS price, "
        "round(quantity, 6) AS quantity, side, order_id, event_type, "
        "date_trunc('millisecond', event_time) AS event_time FROM trades",
    ),
    "json_decode_trades": with_ctes(sample.TRADES, f"SELECT {_TRADE_COLUMNS} FROM trades"),
    "encode_trade_messages": with_ctes(
        sample.TRADES,
        "SELECT symbol AS key, '{\"trade_id\":\"' || trade_id || '\",\"timestamp\":\"' "
        f"|| strftime(event_time, {_STAMP}) || '\",\"symbol\":\"' || symbol || '\",\"price\":' "
        "|| CAST(price AS VARCHAR) || ',\"quantity\":' || CAST(quantity AS VARCHAR) "
        "|| ',\"side\":\"' || side || '\",\"order_id\":\"' || order_id "
        "|| '\",\"event_type\":\"TRADE\",\"trader_id\":\"' || trader_id || '\"}' AS value "
        "FROM trades",
    ),
    "encode_alert_messages": with_ctes(
        sample.WASH_PATH + sample.BARS + sample.LOO + sample.phase_sql("loo") + sample.PUMP_DUMP,
        f"""SELECT '{WASH_ALERTS_TOPIC}' AS topic, symbol AS key,
  '{{"window_start":"' || strftime(window_start, {_STAMP}) || '","window_end":"'
  || strftime(window_end, {_STAMP}) || '","symbol":"' || symbol || '","trade_count":'
  || trade_count || ',"total_volume":' || CAST(round(total_volume, 4) AS VARCHAR)
  || ',"mean_volume":' || CAST(round(mean_volume, 4) AS VARCHAR)
  || ',"std_volume":' || CAST(round(std_volume, 4) AS VARCHAR)
  || ',"z_score":' || CAST(round(z_score, 4) AS VARCHAR) || ',"severity":"' || severity
  || '","alert_type":"WASH_TRADE","detected_at":"' || strftime(detected_at, {_STAMP})
  || '"}}' AS value
FROM wash
UNION ALL
SELECT '{PD_ALERTS_TOPIC}', symbol,
  '{{"window_start":"' || strftime(window_start, {_STAMP}) || '","window_end":"'
  || strftime(window_end, {_STAMP}) || '","symbol":"' || symbol || '","phase":"DUMP'
  || '","pump_price_chg_pct":' || CAST(pump_price_chg_pct AS VARCHAR)
  || ',"dump_price_chg_pct":' || CAST(dump_price_chg_pct AS VARCHAR)
  || ',"price_change_pct":' || CAST(price_change_pct AS VARCHAR)
  || ',"volume_ratio":' || CAST(volume_ratio AS VARCHAR) || ',"severity":"' || severity
  || '","alert_type":"PUMP_DUMP","detected_at":"' || strftime(detected_at, {_STAMP})
  || '"}}'
FROM pump_dump""",
    ),
    "parse_timestamps": with_ctes(_TO_VALIDATED, "SELECT trade_id, event_time FROM parsed"),
    "validate_trades": with_ctes(
        _TO_VALIDATED, "SELECT trade_id, rejection_reason FROM validated"
    ),
    "valid_trades": with_ctes(
        _TO_VALIDATED,
        "SELECT trade_id, symbol, round(CAST(price AS DOUBLE), 6) AS price, "
        "round(CAST(quantity AS DOUBLE), 6) AS quantity, side, order_id, event_type, trader_id, "
        "event_time FROM validated WHERE rejection_reason IS NULL",
    ),
    "dead_letter_rows": with_ctes(
        _TO_VALIDATED,
        'SELECT trade_id, "timestamp", symbol, price, quantity, side, order_id, event_type, '
        f"rejection_reason, TIMESTAMP '{AS_OF}' AS rejected_at "
        "FROM validated WHERE rejection_reason IS NOT NULL",
    ),
    "ingest_quality": with_ctes(
        _TO_VALIDATED,
        "SELECT CASE WHEN rejection_reason IS NULL THEN 'accepted' "
        "WHEN rejection_reason LIKE 'missing_field:%' THEN rejection_reason "
        "ELSE split_part(rejection_reason, ':', 1) END AS outcome, count(*) AS trades "
        "FROM validated GROUP BY 1",
    ),
    "rejections_by_reason": with_ctes(
        _TO_VALIDATED,
        "SELECT rejection_reason, count(*) AS trades FROM validated "
        "WHERE rejection_reason IS NOT NULL GROUP BY 1",
    ),
    "clean_trades": with_ctes(sample.TRADES, f"SELECT {_TRADE_COLUMNS} FROM clean"),
    "ingest_trades": with_ctes(
        sample.TRADES,
        "SELECT trade_id, symbol, round(price, 6) AS price, round(quantity, 6) AS quantity, side, "
        "order_id, event_type, date_trunc('millisecond', event_time) AS event_time "
        "FROM clean WHERE price > 0",
    ),
    "feed_gaps": with_ctes(sample.TRADES, _gap_sql("trades", 5)),
    "feed_gaps_by_symbol": with_ctes(
        sample.TRADES, _gap_sql("trades", 600, "PARTITION BY symbol")
    ),
    "backfill_new_trades": with_ctes(
        sample.TRADES,
        f"SELECT {_TRADE_COLUMNS} FROM trades WHERE side <> 'BUY' "
        "AND event_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'",
    ),
    "merge_backfill": with_ctes(
        sample.TRADES
        + f""",
history AS (SELECT * FROM trades WHERE side = 'BUY'),
gaps AS ({_gap_sql("history", 600)})""",
        f"SELECT {_TRADE_COLUMNS} FROM history UNION ALL "
        f"SELECT {_TRADE_COLUMNS} FROM clean t WHERE price > 0 AND side <> 'BUY' AND EXISTS "
        "(SELECT 1 FROM gaps g WHERE t.event_time BETWEEN g.gap_start AND g.gap_end)",
    ),
}
