"""Product x date x two-hour cells, and the match of stock to sales in them.

Each side is folded to one row per cell before the join, so the join is one to one and a
hot product costs one row per cell however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import time_bucket
from shelfline.model import (
    CELL,
    DEFAULT_CATEGORY,
    DEFAULT_COST_PRICE,
    NO_POS_MATCH,
    PROCESSING_DATE,
)


def inventory_cells(silver: DataFrame) -> DataFrame:
    """The latest stock reading of each cell, whatever the warehouse."""
    reading = F.struct("stock_level", "stock_status", "warehouse_id")
    recency = F.struct("last_updated", "inventory_id")
    return (
        silver.select(
            PROCESSING_DATE,
            "product_id",
            F.to_date("last_updated").alias("analysis_date"),
            time_bucket(F.col("last_updated")).alias("time_bucket"),
            recency.alias("recency"),
            reading.alias("reading"),
        )
        .groupBy(*CELL)
        .agg(
            F.max_by("reading", "recency").alias("latest"),
            F.max("recency.last_updated").alias("inv_timestamp"),
            F.count(F.lit(1)).alias("inventory_rows"),
        )
        .select(*CELL, "latest.*", "inv_timestamp", "inventory_rows")
    )


def pos_store_cells(silver: DataFrame) -> DataFrame:
    """Sales per cell and store; fixed-width buffers only, so it aggregates by hash."""
    return (
        silver.select(
            PROCESSING_DATE,
            "product_id",
            F.to_date("transaction_timestamp").alias("analysis_date"),
            time_bucket(F.col("transaction_timestamp")).alias("time_bucket"),
            "store_id",
            "quantity",
            "revenue",
            "discount_applied",
            "transaction_id",
            "transaction_timestamp",
        )
        .groupBy(*CELL, "store_id")
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum("revenue").alias("revenue"),
            F.sum("discount_applied").alias("discount"),
            F.count("transaction_id").alias("transactions"),
            F.max("transaction_timestamp").alias("pos_timestamp"),
        )
    )


def pos_cells(silver: DataFrame) -> DataFrame:
    """Sales per cell, with what each store contributed (one entry per store)."""
    share = F.struct("store_id", "quantity", "revenue", "transactions")
    return (
        pos_store_cells(silver)
        .groupBy(*CELL)
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("discount").alias("total_discount"),
            F.sum("transactions").alias("transaction_count"),
            F.array_sort(F.collect_list(share)).alias("store_sales"),
            F.max("pos_timestamp").alias("pos_timestamp"),
        )
        .withColumn("store_list", F.col("store_sales.store_id"))
    )


def match_cells(inventory: DataFrame, pos: DataFrame) -> DataFrame:
    """All cells of both sides. Which side is present tells matched from unmatched.

    Both sides arrive partitioned on the cell by their aggregation, so the join itself adds
    no shuffle. Filters on the presence flags let the optimizer narrow the join.
    """
    return inventory.join(pos, CELL, "full")


def matched(cells: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Cells with both a stock reading and sales, in the joined fact's layout.

    ``products`` (product_id, cost_price, category) replaces the placeholder cost and
    category where it has the product.
    """
    both = cells.filter(
        F.col("inventory_rows").isNotNull() & F.col("transaction_count").isNotNull()
    )
    cost, category = F.lit(DEFAULT_COST_PRICE), F.lit(DEFAULT_CATEGORY)
    if products is not None:
        both = both.join(products, "product_id", "left")
        cost = F.coalesce(F.col("cost_price"), cost)
        category = F.coalesce(F.col("category"), category)
    return both.select(
        *CELL,
        "stock_level",
        "stock_status",
        "warehouse_id",
        cost.alias("cost_price"),
        category.alias("category"),
        "total_quantity",
        "total_revenue",
        "total_discount",
        "transaction_count",
        "store_list",
        "store_sales",
        "inv_timestamp",
        "pos_timestamp",
    )


def failed(cells: DataFrame) -> DataFrame:
    """Stock readings whose cell has no sales."""
    return cells.filter(
        F.col("inventory_rows").isNotNull() & F.col("transaction_count").isNull()
    ).select(
        *CELL, "stock_level", "warehouse_id", F.lit(NO_POS_MATCH).alias("error_reason")
    )
