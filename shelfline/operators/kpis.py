"""Daily figures over the matched cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import money
from shelfline.model import PROCESSING_DATE

_DAY = [PROCESSING_DATE, "analysis_date"]


def sales_kpis(joined: DataFrame) -> DataFrame:
    """Average price is the plain mean of each cell's price; cells without items are skipped."""
    price = F.try_divide(F.col("total_revenue"), F.col("total_quantity"))
    return (
        joined.groupBy(*_DAY)
        .agg(
            money(F.sum("total_revenue")).alias("total_daily_revenue"),
            F.sum("total_quantity").alias("total_daily_quantity_sold"),
            money(F.sum("total_discount")).alias("total_daily_discount_given"),
            F.count_distinct("product_id").alias("distinct_products_sold_daily"),
            money(F.avg(price)).alias("average_price_per_item"),
        )
        .dropna(subset=_DAY)
    )


def inventory_kpis(joined: DataFrame) -> DataFrame:
    """Stock is added over buckets, and the status counts are counts of cells."""
    grain = [*_DAY, "warehouse_id"]
    return (
        joined.groupBy(*grain)
        .agg(
            F.sum("stock_level").alias("total_stock_level"),
            F.count_distinct("product_id").alias("distinct_products_in_stock"),
            F.count_if(F.col("stock_status") == "IN_STOCK").alias("products_in_stock"),
            F.count_if(F.col("stock_status") == "OUT_OF_STOCK").alias("products_out_of_stock"),
            money(F.sum(F.col("stock_level") * F.col("cost_price"))).alias("total_stock_value"),
        )
        .dropna(subset=grain)
    )


def regional_kpis(joined: DataFrame) -> DataFrame:
    """Every store seen in a cell is credited with the whole cell."""
    grain = [*_DAY, "store_id"]
    return (
        joined.select(
            *_DAY,
            F.explode("store_list").alias("store_id"),
            "total_revenue",
            "total_quantity",
            "transaction_count",
        )
        .groupBy(*grain)
        .agg(
            money(F.sum("total_revenue")).alias("store_daily_revenue"),
            F.sum("total_quantity").alias("store_daily_quantity_sold"),
            F.sum("transaction_count").alias("store_daily_transactions"),
        )
        .dropna(subset=grain)
    )


def regional_kpis_exact(joined: DataFrame) -> DataFrame:
    """Every store is credited with its own sales only, so stores add up to the sales figure."""
    grain = [*_DAY, "store_id"]
    return (
        joined.select(*_DAY, F.inline("store_sales"))
        .groupBy(*grain)
        .agg(
            money(F.sum("revenue")).alias("store_daily_revenue"),
            F.sum("quantity").alias("store_daily_quantity_sold"),
            F.sum("transactions").alias("store_daily_transactions"),
        )
        .dropna(subset=grain)
    )


def processing_metrics(cells: DataFrame) -> DataFrame:
    """Rows read, cells joined and match rates per processing date, from the cells alone."""
    inv, pos = F.col("inventory_rows"), F.col("transaction_count")
    joined = F.count_if(inv.isNotNull() & pos.isNotNull())
    rows = F.coalesce(F.sum(inv), F.lit(0))
    inv_cells = F.count(inv)
    return cells.groupBy(PROCESSING_DATE).agg(
        rows.alias("inventory_records_read"),
        F.coalesce(F.sum(pos), F.lit(0)).alias("pos_records_read"),
        joined.alias("joined_records"),
        F.coalesce(F.try_divide(joined, rows) * 100, F.lit(0.0)).alias("join_success_rate"),
        F.coalesce(F.try_divide(joined, inv_cells) * 100, F.lit(0.0)).alias("cell_match_rate"),
    )
