"""Event-time parsing (T1, T2, T3) and duration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_timestamp_text(col: Column) -> Column:
    """ISO-8601 text -> timestamp, NULL when unparseable (never raises under ANSI).

    The default parser accepts ``2026-05-16T23:05:01Z``, ``...01.000Z``,
    ``...01.123456Z``, explicit offsets (``+02:00``) and a space separator, so
    the fixed-pattern fallbacks are not needed.  Offsets are honoured; text
    without a zone is read in the session zone, which the library pins to UTC.
    """
    return F.try_to_timestamp(col)


def _as_timestamp(df: DataFrame, name: str) -> Column | None:
    if name not in df.columns:
        return None
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    return parse_timestamp_text(F.col(name).cast("string"))


def event_time(df: DataFrame, text_col: str = "occurred_at", parsed_col: str = "occurred_at_ts") -> Column:
    """Event time in UTC: the text column first, then an already parsed column.

    Either column may be absent.  With the session zone at UTC the result is
    already UTC, so no zone conversion is applied.
    """
    candidates = [c for c in (_as_timestamp(df, text_col), _as_timestamp(df, parsed_col)) if c is not None]
    if not candidates:
        return F.lit(None).cast("timestamp")
    return candidates[0] if len(candidates) == 1 else F.coalesce(*candidates)


def whole_seconds_between(start: Column, end: Column) -> Column:
    """Seconds between two timestamps, each truncated to the whole second first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)
