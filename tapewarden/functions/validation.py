"""First failing check of a trade as a native column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewarden.config import EVENT_TYPES, SIDES
from tapewarden.functions.timestamps import parse_iso_timestamp
from tapewarden.schema import REQUIRED_TRADE_FIELDS

# Decimal number text, where single underscores may part digits,
# and the characters that count as blank.
NUMBER_TEXT = (
    r"^\s*([+-]?(?:\d(?:_?\d)*(?:\.(?:\d(?:_?\d)*)?)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?)\s*$"
)
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def parse_number(text: Column) -> Column:
    """Number text to double, null for anything else (also nan and inf).

    Texts of digits, signs, points and exponents are cast as they are; others
    must match the full pattern first, for the cast would take a trailing
    ``d`` or hexadecimal digits. Add the result with ``with_once``.
    """
    # Blank where nothing matches, and a blank casts to null.
    parted = F.regexp_replace(F.regexp_extract(text, NUMBER_TEXT, 1), "_", "")
    return F.when(text.rlike(r"[^0-9eE+.\s-]"), parted).otherwise(text).try_cast("double")


def parsed_fields(df: DataFrame) -> Column:
    """Price, quantity and time of a trade as numbers and timestamp, null where invalid.

    ``df`` may hold price and quantity as text or as numbers, and the time as
    ISO text or, in ``event_time``, as a timestamp.
    """
    kinds = dict(df.dtypes)

    def number(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("double")
        if kinds[name] == "string":
            return parse_number(F.col(name))
        value = F.col(name).cast("double")
        finite = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
        return F.when(finite, value)

    if "event_time" in kinds:
        time = F.col("event_time")
    elif kinds.get("timestamp") == "string":
        time = parse_iso_timestamp(F.col("timestamp"))
    else:
        time = F.col("timestamp") if "timestamp" in kinds else F.lit(None)
    return F.struct(
        number("price").alias("price"),
        number("quantity").alias("quantity"),
        time.cast("timestamp").alias("event_time"),
    )


def number_text(number: Column) -> Column:
    """A double as text: plain notation from 1e-4 up to 1e16, with a fraction of at least one digit."""
    size = F.abs(number)
    plain = F.regexp_replace(number.cast("decimal(38, 20)").cast("string"), r"(\.\d+?)0+$", "$1")
    # Spark switches to exponents below 1e-3 and from 1e7 on.
    middle = (size < 1e16) & ((size >= 1e7) | ((size >= 1e-4) & (size < 1e-3)))
    return F.when(middle, plain).otherwise(number.cast("string"))


def _is_missing(name: str, kind: str) -> Column:
    missing = F.col(name).isNull()
    return missing | (F.btrim(name, F.lit(BLANKS)) == "") if kind == "string" else missing


def rejection_reason(df: DataFrame, symbols: Sequence[str] | None) -> Column:
    """Reason of the first failing check, null for a valid trade.

    Order: required fields, price, quantity, timestamp, side, event type,
    symbol. ``df`` has ``parsed`` from ``parsed_fields``. A field it lacks is
    missing. NaN and infinite numbers count as invalid.
    """
    kinds = dict(df.dtypes)
    absent = [name for name in REQUIRED_TRADE_FIELDS if name not in kinds]
    checks: list[tuple[Column, Column]] = []
    for name in REQUIRED_TRADE_FIELDS:
        failed = F.lit(True) if name in absent else _is_missing(name, kinds[name])
        checks.append((failed, F.lit(f"missing_field:{name}")))
    if not absent:
        for name in ("price", "quantity"):
            number, raw = F.col(f"parsed.{name}"), F.col(name).cast("string")
            checks.append((number.isNull(), F.concat(F.lit(f"invalid_{name}:"), raw)))
            checks.append(
                (number <= 0, F.concat(F.lit(f"non_positive_{name}:"), number_text(number)))
            )
        stamp = F.col("timestamp").cast("string")
        checks.append(
            (F.col("parsed.event_time").isNull(), F.concat(F.lit("invalid_timestamp:"), stamp))
        )
        checks.append((~F.col("side").isin(*SIDES), F.concat(F.lit("invalid_side:"), "side")))
        checks.append(
            (
                ~F.col("event_type").isin(*EVENT_TYPES),
                F.concat(F.lit("invalid_event_type:"), "event_type"),
            )
        )
        if symbols is not None:
            checks.append(
                (~F.col("symbol").isin(*symbols), F.concat(F.lit("unknown_symbol:"), "symbol"))
            )
    reason = F.when(*checks[0])
    for failed, text in checks[1:]:
        reason = reason.when(failed, text)
    return reason.cast("string")
