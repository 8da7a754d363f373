"""Time conversions that do not depend on the session time zone.

Test tables store wall-clock ``TIMESTAMP_NTZ``; watermarks need ``TIMESTAMP``.
Both are mapped through epoch microseconds, reading the wall clock as UTC,
so results are the same whatever ``spark.sql.session.timeZone`` is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def epoch_ntz() -> Column:
    # A typed literal: a Python datetime would pass through the session zone.
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970-01-01 for a TIMESTAMP or TIMESTAMP_NTZ column."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", epoch_ntz(), F.col(col))
    return F.unix_micros(F.col(col))


def to_instant(df: DataFrame, col: str) -> Column:
    """As ``TIMESTAMP`` (an instant), NTZ wall clock read as UTC."""
    return F.timestamp_micros(epoch_micros(df, col))


def instant_to_ntz(c: Column) -> Column:
    """A ``TIMESTAMP`` back to UTC wall clock ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch_ntz())


def seconds_text(micros: Column) -> Column:
    """Epoch seconds with six decimals, e.g. ``1704067798.778549`` (non-negative times)."""
    frac = F.pmod(micros, F.lit(1000000))
    whole = ((micros - frac) / F.lit(1000000)).cast("long")  # exact: an integer multiple of 1e6
    return F.format_string("%d.%06d", whole, frac)
