"""Raw exchange events and JSON trade messages as typed trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewarden.functions.costly import with_once
from tapewarden.functions.timestamps import iso_text, parse_iso_timestamp
from tapewarden.schema import EXCHANGE_EVENT, TRADE


def normalize_exchange_events(raw: DataFrame) -> DataFrame:
    """Exchange events (``value`` holds the JSON) as trades with text numbers.

    Events come bare or in a ``{"stream", "data"}`` envelope; a paged answer
    lacks the symbol, then the frame's own ``symbol`` column is used. Prices
    stay text so that validation can report what it rejects. A buyer that is
    the maker means a SELL, in live and paged events alike. Without an
    exchange id the message hash is the id, so a replay gives the same one.
    """
    event = F.from_json(F.col("value").cast("string"), EXCHANGE_EVENT)
    parsed = with_once(raw, "_e", event)

    def field(name: str):
        return F.coalesce(F.col(f"_e.data.{name}"), F.col(f"_e.{name}"))

    asked = F.col("symbol") if "symbol" in raw.columns else F.lit(None).cast("string")
    event_time = F.timestamp_millis(field("T"))
    order_id = F.coalesce(field("a").cast("string"), F.sha2(F.col("value").cast("string"), 256))
    return parsed.select(
        order_id.alias("trade_id"),
        iso_text(event_time).alias("timestamp"),
        F.coalesce(field("s"), asked).alias("symbol"),
        field("p").alias("price"),
        field("q").alias("quantity"),
        F.when(field("m"), "SELL").when(~field("m"), "BUY").alias("side"),
        order_id.alias("order_id"),
        F.lit("TRADE").alias("event_type"),
        event_time.alias("event_time"),
    )


def decode_trades(messages: DataFrame) -> DataFrame:
    """JSON trade messages as typed trades with ``event_time``."""
    trade = F.from_json(F.col("value").cast("string"), TRADE)
    decoded = with_once(messages.select("value"), "_t", trade).select("_t.*")
    return with_once(decoded, "event_time", parse_iso_timestamp(F.col("timestamp")))
