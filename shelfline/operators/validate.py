"""Row checks: typed columns plus one reason per rejected row, in a single projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.casts import lenient_cast
from shelfline.functions.columns import once
from shelfline.model import BROKEN_RULE, MISSING_COLUMNS, NULL_FIELD, PROCESSING_DATE, Feed

REASON = "error_reason"


def missing_columns(df: DataFrame, feed: Feed) -> list[str]:
    return [c for c in feed.required if c not in df.columns]


def missing_reason(missing: Sequence[str]) -> str:
    return MISSING_COLUMNS.format(list(missing))


def conform(df: DataFrame, feed: Feed, carry: Sequence[str] = (PROCESSING_DATE,)) -> DataFrame:
    """Declared columns in declared order and type; an absent nullable one is NULL."""

    def declared(field) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = df.schema[field.name].dataType
        return lenient_cast(F.col(field.name), source, field.dataType).alias(field.name)

    kept = [F.col(c) for c in carry if c in df.columns]
    return df.select(*[declared(f) for f in feed.schema], *kept)


def reason(feed: Feed) -> Column:
    """The reason of the strongest failed check, else NULL.

    Rules outrank null checks, and among equals the column declared later wins. A check
    that is NULL counts as passed, so a null that only a null check can see keeps the null
    message.
    """
    nulls = [F.when(F.col(c).isNull(), NULL_FIELD.format(c)) for c in feed.required]
    rules = [
        F.when(~holds(F.col(c)), BROKEN_RULE.format(c)) for c, holds in feed.rules.items()
    ]
    return F.coalesce(*reversed(nulls + rules))


def check(df: DataFrame, feed: Feed, carry: Sequence[str] = (PROCESSING_DATE,)) -> DataFrame:
    """Add ``error_reason``; rows with NULL there are valid.

    A frame that lacks a required column is rejected whole, with its columns unchanged.
    """
    missing = missing_columns(df, feed)
    if missing:
        return df.withColumn(REASON, F.lit(missing_reason(missing)))
    return once(conform(df, feed, carry), REASON, reason(feed))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def invalid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull())


def summary(checked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals, rate in percent and status, from one pass over the checked rows."""
    counted = checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(REASON).isNull()).alias("valid_rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("invalid_rows"),
    )
    rate = F.col("valid_rows") / F.col("total_rows") * 100
    return counted.withColumns(
        {
            "validation_rate": F.when(F.col("total_rows") > 0, rate).otherwise(F.lit(0.0)),
            "status": F.when(F.col("invalid_rows") == 0, "success").otherwise(
                "partial_success"
            ),
        }
    )
