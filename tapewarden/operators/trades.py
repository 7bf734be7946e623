"""Cleaning, splitting and deduplicating trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewarden.functions.costly import with_once
from tapewarden.functions.timestamps import parse_iso_timestamp
from tapewarden.functions.validation import parsed_fields, rejection_reason
from tapewarden.schema import DEAD_LETTER_COLUMNS, TRADE_KEY


def with_event_time(trades: DataFrame) -> DataFrame:
    """Add ``event_time`` parsed from the ISO text; null where it does not parse."""
    if "event_time" in trades.columns:
        return trades
    return with_once(trades, "event_time", parse_iso_timestamp(F.col("timestamp")))


def clean_trades(trades: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    """Rows the detectors may use: a time, a positive quantity, a known symbol."""
    clean = with_event_time(trades).filter(
        F.col("event_time").isNotNull() & (F.col("quantity") > 0)
    )
    return clean if symbols is None else clean.filter(F.col("symbol").isin(*symbols))


def validate_trades(trades: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    """Add ``rejection_reason``, null for a valid trade, and the ``parsed`` fields."""
    parsed = with_once(trades, "parsed", parsed_fields(trades))
    return with_once(parsed, "rejection_reason", rejection_reason(parsed, symbols))


def valid_only(validated: DataFrame) -> DataFrame:
    """Valid rows as typed trades with ``event_time``."""
    kept = validated.filter(F.col("rejection_reason").isNull())
    typed = {name: F.col(f"parsed.{name}") for name in ("price", "quantity", "event_time")}
    return kept.withColumns(typed).drop("parsed", "rejection_reason")


def rejected_only(validated: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """Rejected rows in the dead-letter column order; absent fields are null."""
    kept = validated.filter(F.col("rejection_reason").isNotNull()).withColumn(
        "rejected_at", F.current_timestamp() if rejected_at is None else rejected_at
    )
    return kept.select(
        *[
            F.col(c) if c in kept.columns else F.lit(None).cast("string").alias(c)
            for c in DEAD_LETTER_COLUMNS
        ]
    )


def dedup_trades(trades: DataFrame) -> DataFrame:
    """One row per (symbol, order_id), the earliest.

    Filtering ``row_number`` to 1 lets Spark drop duplicates inside each input
    partition before the shuffle (WindowGroupLimit), so many copies of one
    trade do not meet in one task.
    """
    earliest = Window.partitionBy(*TRADE_KEY).orderBy("event_time", "trade_id")
    return (
        trades.withColumn("_copy", F.row_number().over(earliest))
        .filter(F.col("_copy") == 1)
        .drop("_copy")
    )


def ingest_quality(validated: DataFrame) -> DataFrame:
    """Rows and share by outcome; ``accepted`` counts the valid ones.

    Reasons are grouped by kind (the text before the offending value) so that
    the result stays small on any input.
    """
    kind = F.coalesce(F.substring_index("rejection_reason", ":", 1), F.lit("accepted"))
    missing = F.col("rejection_reason").startswith("missing_field:")
    outcome = F.when(missing, F.col("rejection_reason")).otherwise(kind)
    return validated.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("trades"))


def rejections_by_reason(validated: DataFrame) -> DataFrame:
    """Rejected rows per full reason text."""
    return (
        validated.filter(F.col("rejection_reason").isNotNull())
        .groupBy("rejection_reason")
        .agg(F.count(F.lit(1)).alias("trades"))
    )
