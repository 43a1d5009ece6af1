"""Derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that it is computed once per row.

    A plain projection may be merged into its uses, and a later filter may take a copy of
    it below; neither crosses an explode, here of a single element.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


# Category bounds and names.
def sale_category(revenue: Column) -> Column:
    return (
        F.when(revenue >= 100, "HIGH_VALUE")
        .when(revenue >= 50, "MEDIUM_VALUE")
        .otherwise("LOW_VALUE")
    )


# Stock bounds and names.
def stock_status(level: Column) -> Column:
    return (
        F.when(level == 0, "OUT_OF_STOCK")
        .when(level < 10, "LOW_STOCK")
        .otherwise("IN_STOCK")
    )


def time_bucket(ts: Column) -> Column:
    """Even hour 0..22 opening the two-hour bucket, as bigint."""
    return (F.hour(ts) - F.hour(ts) % 2).cast("bigint")


def money(c: Column) -> Column:
    """An amount at the figures' precision; NULL for NaN, infinity, or one too large."""
    return c.try_cast("decimal(18,4)")
