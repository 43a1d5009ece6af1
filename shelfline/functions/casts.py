"""Lenient casts: a value that does not fit becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# timestamp_seconds overflows beyond this many seconds.
_MAX_EPOCH_SECONDS = 9_223_372_036_854

# What a cast is tried on. A failing cast costs an exception per row, so text that cannot
# succeed is sorted out by pattern first.
_WHOLE = r"^\s*[+-]?\d+\s*$"
_WHOLE_AND_FRACTION = r"^\s*[+-]?\d+\.\d*\s*$"
_FRACTION = r"^\s*[+-]?\.\d+\s*$"
_MAYBE_FRACTIONAL = r"(?i)^\s*[+-]?(\.?\d|nan|inf)"
# Decimal notation only: the JVM would also read type suffixes (3d) and hexadecimal.
_DECIMAL = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def lenient_cast(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast to the declared type. Text such as ``3.7`` truncates for whole numbers."""
    if not isinstance(source, T.StringType):
        return c.try_cast(target)
    if isinstance(target, T.IntegralType):
        whole = (
            F.when(c.rlike(_WHOLE), c)
            .when(c.rlike(_WHOLE_AND_FRACTION), F.substring_index(c, ".", 1))
            .when(c.rlike(_FRACTION), F.lit("0"))
        )
        return whole.try_cast(target)
    if isinstance(target, T.FractionalType):
        return F.when(c.rlike(_MAYBE_FRACTIONAL), c).try_cast(target)
    return c.try_cast(target)


def as_number(text: Column) -> Column:
    """Text as a double; NULL for anything that is not a decimal number, NaN or infinity."""
    return F.when(text.rlike(_DECIMAL), text).try_cast("double")


def is_finite(d: Column) -> Column:
    return ~F.isnan(d) & (F.abs(d) != float("inf"))


def safe_int(text: Column) -> Column:
    """Truncate to int; NULL when missing, junk, not finite, or out of range."""
    return as_number(text).try_cast("int")


def safe_rating(text: Column) -> Column:
    """Truncate, clamp to 1..5; 3 when missing, junk or not finite."""
    d = as_number(text)
    clamped = F.greatest(F.lit(1.0), F.least(F.lit(5.0), d)).cast("int")
    return F.when(is_finite(d), clamped).otherwise(F.lit(3))


def epoch_seconds_to_timestamp(seconds: Column) -> Column:
    """Whole epoch seconds to a timestamp; NULL beyond what a timestamp can hold."""
    fits = F.abs(seconds) <= _MAX_EPOCH_SECONDS
    return F.when(fits, F.timestamp_seconds(seconds))


def epoch_to_timestamp(d: Column) -> Column:
    """Fractional epoch seconds to a timestamp, rounded to the microsecond."""
    fits = is_finite(d) & (F.abs(d) <= _MAX_EPOCH_SECONDS)
    return F.when(fits, F.timestamp_micros(F.round(d * 1_000_000.0).cast("bigint")))


def epoch_text_to_timestamp(text: Column) -> Column:
    return epoch_to_timestamp(as_number(text))


def iso_or_epoch(text: Column) -> Column:
    """Text holding a ``T`` is read as ISO-8601, anything else as epoch seconds.

    Text with a ``T`` that is no timestamp gives NULL.
    """
    iso = F.when(text.rlike(r"^\s*\d{4}-"), F.try_to_timestamp(text))
    return F.when(text.contains("T"), iso).otherwise(epoch_text_to_timestamp(text))


def any_timestamp(text: Column) -> Column:
    """Loader's automatic time format: ISO with ``T`` or a space, or epoch seconds."""
    iso = F.when(text.rlike(r"^\s*\d{4}-"), F.try_to_timestamp(text))
    return F.coalesce(iso, epoch_text_to_timestamp(text))


def clip(text: Column, width: int) -> Column:
    """Cut text to a column's declared width."""
    return F.substring(text, 1, width)
