"""Alert rows: messages to tables, routing, searching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewarden.config import PD_ALERTS_TOPIC, WASH_ALERTS_TOPIC
from tapewarden.functions.costly import with_once
from tapewarden.functions.timestamps import ISO_MESSAGE_FORMAT, parse_iso_timestamp
from tapewarden.schema import PUMP_DUMP_ALERTS, WASH_ALERTS, KeyedTable

ALERT_TABLE_OF_TOPIC = {WASH_ALERTS_TOPIC: WASH_ALERTS, PD_ALERTS_TOPIC: PUMP_DUMP_ALERTS}
_DEFAULT_TYPE = {WASH_ALERTS.name: "WASH_TRADE", PUMP_DUMP_ALERTS.name: "PUMP_DUMP"}


def route_alerts(messages: DataFrame) -> DataFrame:
    """Add the table each message belongs to; null for an unknown topic."""
    route = F.lit(None).cast("string")
    for topic, table in ALERT_TABLE_OF_TOPIC.items():
        route = F.when(F.col("topic") == topic, table.name).otherwise(route)
    return messages.withColumn("target_table", route)


def _message_schema(table: KeyedTable) -> T.StructType:
    """Message fields: times are text, and the z-score may go by its alias."""
    fields = [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
        for f in table.schema.fields
    ]
    if "z_score" in table.schema.names:
        fields.append(T.StructField("zscore", T.DoubleType()))
    return T.StructType(fields)


def decode_alerts(
    messages: DataFrame, table: KeyedTable, received_at: Column | None = None
) -> DataFrame:
    """Alert messages of one table as rows; the raw text stays in ``value``."""
    body = F.from_json(F.col("value"), _message_schema(table))
    sent = with_once(messages.select("value"), "_a", body).select("value", "_a.*")
    return normalize_alerts(sent, table, received_at)


def normalize_alerts(
    alerts: DataFrame, table: KeyedTable, received_at: Column | None = None
) -> DataFrame:
    """Fill alias and defaults and bring the columns to the table's types and order.

    ``value`` (the message text), when present, is kept for the reject table.
    """
    received = F.current_timestamp() if received_at is None else received_at

    def column(field: T.StructField) -> Column:
        names = [field.name]
        if field.name == "z_score":
            names.append("zscore")
        present = []
        for name in names:
            if name not in alerts.columns:
                continue
            column = F.col(name)
            if isinstance(field.dataType, T.TimestampType) and dict(alerts.dtypes)[name] == "string":
                column = parse_iso_timestamp(column)
            present.append(column.cast(field.dataType))
        if field.name == "alert_type":
            present.append(F.lit(_DEFAULT_TYPE[table.name]))
        if field.name == "detected_at":
            present.append(received)
        return F.coalesce(*present, F.lit(None).cast(field.dataType)).alias(field.name)

    extra = [F.col("value")] if "value" in alerts.columns else []
    return alerts.select(*[column(f) for f in table.schema.fields], *extra)


def constraint_error(table: KeyedTable) -> Column:
    """First broken constraint of a row of ``table``, null when it may be stored."""
    error = F.lit(None).cast("string")
    for name, length in reversed(table.limits):
        error = F.when(F.length(name) > length, f"too_long:{name}").otherwise(error)
    for name in reversed(table.required):
        error = F.when(F.col(name).isNull(), f"null:{name}").otherwise(error)
    return error


def check_constraints(rows: DataFrame, table: KeyedTable) -> DataFrame:
    """Add ``constraint_error``."""
    return rows.withColumn("constraint_error", constraint_error(table))


def critical_feed(alerts: DataFrame) -> DataFrame:
    """CRITICAL alerts with the message text to raise."""
    columns = [F.col(c) for c in alerts.columns if c != "value"]
    body = F.to_json(F.struct(*columns), {"timestampFormat": ISO_MESSAGE_FORMAT})
    # Fixed value: the words of a critical message.
    text = F.concat(
        F.lit("CRITICAL ALERT: "), "alert_type", F.lit(" on "), "symbol", F.lit(" — "), body
    )
    return alerts.filter(F.col("severity") == "CRITICAL").select(
        "window_start", "symbol", "alert_type", "severity", text.alias("message")
    )


def all_alerts(wash: DataFrame, pump_dump: DataFrame) -> DataFrame:
    """Both kinds in one frame; columns one kind lacks are null."""
    return wash.unionByName(pump_dump, allowMissingColumns=True)


def search_alerts(
    alerts: DataFrame,
    symbol: str | None = None,
    severity: str | None = None,
    limit: int | None = None,
    tie_break: Sequence[str] = ("window_start", "symbol"),
) -> DataFrame:
    """Alerts of one table under optional filters (pushed into the scan); with a ``limit``, the newest."""
    if symbol is not None:
        alerts = alerts.filter(F.col("symbol") == symbol)
    if severity is not None:
        alerts = alerts.filter(F.col("severity") == severity)
    if limit is None:
        return alerts
    return alerts.orderBy(F.desc("detected_at"), *tie_break).limit(limit)


def query_alerts(
    wash: DataFrame,
    pump_dump: DataFrame,
    alert_type: str = "all",
    symbol: str | None = None,
    severity: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Alert search over one or both tables; a limit holds per table."""
    if alert_type not in ("all", "wash", "pump_dump"):
        raise ValueError(f"unknown alert type: {alert_type!r}")
    parts = []
    if alert_type in ("wash", "all"):
        parts.append(search_alerts(wash, symbol, severity, limit))
    if alert_type in ("pump_dump", "all"):
        parts.append(search_alerts(pump_dump, symbol, severity, limit))
    return parts[0] if len(parts) == 1 else all_alerts(*parts)


def within_lookback(
    alerts: DataFrame, column: str, minutes: int | None, as_of: Column | None = None
) -> DataFrame:
    """Rows whose ``column`` lies in the last ``minutes``; all rows for None."""
    if minutes is None or column not in alerts.columns:
        return alerts
    now = F.current_timestamp() if as_of is None else as_of
    return alerts.filter(F.col(column) >= now - F.make_dt_interval(mins=F.lit(minutes)))


def known_symbols(alerts: DataFrame, symbols: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of known symbols, given as a list or as a table with a ``symbol`` column."""
    if isinstance(symbols, DataFrame):
        return alerts.join(symbols.select("symbol"), "symbol", "left_semi")
    return alerts.filter(F.col("symbol").isin(*symbols))
