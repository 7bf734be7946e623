"""Time parsing, formatting and time blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted ISO-8601 forms. A date alone, or with a time after T or
# a blank: hours, minutes, seconds, up to 9 fraction digits, optional zone. Date
# and time may be in basic form (20260131T100000). Week dates are not accepted.
_ZONE = r"(?:Z|[+-]\d{2}:?\d{2})"
ISO_TEXT = rf"^\d{{4}}-\d{{2}}-\d{{2}}(?:[T ]\d{{2}}:\d{{2}}(?::\d{{2}}(?:\.\d{{1,9}})?)?{_ZONE}?)?$"
ISO_BASIC_DATE = r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])"
ISO_BASIC_TIME = r"(?<=[T ])(\d{2})(\d{2})(\d{2})(?=$|[.Z+-])"
ISO_HOUR_ONLY = rf"(?<=[T ])(\d{{2}})(?={_ZONE}?$)"
ISO_MESSAGE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parse_iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to timestamp (session zone where none is given); else null.

    The extended form, which nearly all rows have, takes one pattern test; only
    other texts are rewritten. Add the result with ``with_once``.
    """
    extended = F.regexp_replace(text, ISO_BASIC_DATE, "$1-$2-$3")
    extended = F.regexp_replace(extended, ISO_BASIC_TIME, "$1:$2:$3")
    extended = F.regexp_replace(extended, ISO_HOUR_ONLY, "$1:00")
    # What does not match becomes blank, which casts to null.
    rewritten = F.regexp_extract(extended, ISO_TEXT, 0)
    return F.when(text.rlike(ISO_TEXT), text).otherwise(rewritten).try_cast("timestamp")


def iso_text(time: Column) -> Column:
    return F.date_format(time, ISO_MESSAGE_FORMAT)


def to_display_zone(df: DataFrame, zone: str, columns: tuple[str, ...] = ("detected_at",)) -> DataFrame:
    """Shift UTC times to a display zone; window times stay as they are."""
    return df.withColumns(
        {c: F.from_utc_timestamp(F.col(c), zone) for c in columns if c in df.columns}
    )


def time_block(time: Column, seconds: int) -> Column:
    """Number of the fixed-length block a time lies in."""
    return F.floor(F.unix_micros(time) / F.lit(seconds * 1_000_000)).cast("long")


def as_utc_wall_time(df: DataFrame) -> DataFrame:
    """Timestamps as zone-free wall time (the session zone must be UTC)."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )
