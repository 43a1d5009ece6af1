"""Validated rows to the silver layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.casts import epoch_seconds_to_timestamp
from shelfline.functions.columns import sale_category, stock_status
from shelfline.model import PROCESSING_DATE


def stamp_date(df: DataFrame, day: str) -> DataFrame:
    """Put one processing date on every row."""
    return df.withColumn(PROCESSING_DATE, F.lit(day).cast("date"))


def enrich_pos(valid: DataFrame) -> DataFrame:
    return valid.withColumns(
        {
            "transaction_timestamp": epoch_seconds_to_timestamp(F.col("timestamp")),
            "sale_category": sale_category(F.col("revenue")),
        }
    )


def enrich_inventory(valid: DataFrame) -> DataFrame:
    """Fractions of the epoch are cut off; the timestamp takes over the column's name."""
    seconds = F.col("last_updated").try_cast("bigint")
    return valid.select(
        "inventory_id",
        "product_id",
        "warehouse_id",
        "stock_level",
        "restock_threshold",
        epoch_seconds_to_timestamp(seconds).alias("last_updated"),
        stock_status(F.col("stock_level")).alias("stock_status"),
        PROCESSING_DATE,
    )


def audit(df: DataFrame, run_id: str, loaded_at: str) -> DataFrame:
    """Run id and load time. ``loaded_at`` names the time column."""
    return df.withColumns({"job_run_id": F.lit(run_id), loaded_at: F.current_timestamp()})
