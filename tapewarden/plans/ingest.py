"""Ingest: raw exchange events to validated, deduplicated trades, and gap repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tapewarden.operators.gaps import feed_gaps, merge_backfill, new_trades, trades_in_gaps
from tapewarden.operators.trades import (
    dedup_trades,
    rejected_only,
    valid_only,
    validate_trades,
)
from tapewarden.sources.exchange import normalize_exchange_events


def ingest_trades(
    raw: DataFrame, symbols: Sequence[str] | None, rejected_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid deduplicated trades, rejected trades) of raw exchange messages."""
    validated = validate_trades(normalize_exchange_events(raw), symbols)
    return dedup_trades(valid_only(validated)), rejected_only(validated, rejected_at)


def repair_gaps(
    history: DataFrame,
    fetched: DataFrame,
    symbols: Sequence[str] | None,
    gap_seconds: int = 5,
    by: Sequence[str] = (),
) -> DataFrame:
    """History with its feed gaps filled from fetched trades that pass validation."""
    gaps = feed_gaps(history, gap_seconds, by)
    valid = valid_only(validate_trades(fetched, symbols))
    missing = new_trades(trades_in_gaps(valid, gaps, by), history)
    return merge_backfill(history, missing)
