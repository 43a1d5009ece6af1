"""Cells, their match, and the daily figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions.columns import money
from shelfline.operators import cells, kpis
from shelfline.queries.batch import inventory_silver, pos_silver
from shelfline.queries.registry import query
from shelfline.sources import tables

def _cells(spark, sf):
    return cells.match_cells(
        cells.inventory_cells(inventory_silver(spark, sf)),
        cells.pos_cells(pos_silver(spark, sf)),
    )


def _shown(df):
    """Sums of fractions at the figures' precision, the stores as text."""
    return df.drop("store_sales").withColumns(
        {
            "total_revenue": money(F.col("total_revenue")),
            "total_discount": money(F.col("total_discount")),
            "store_list": F.array_join("store_list", ","),
        }
    )


@query
def inventory_bucket_agg(spark, sf):
    return cells.inventory_cells(inventory_silver(spark, sf))


@query
def pos_bucket_agg(spark, sf):
    return _shown(cells.pos_cells(pos_silver(spark, sf)))


@query
def bucket_join(spark, sf):
    return _shown(cells.matched(_cells(spark, sf)))


@query
def failed_joins(spark, sf):
    return cells.failed(_cells(spark, sf))


@query
def sales_kpis(spark, sf):
    return kpis.sales_kpis(cells.matched(_cells(spark, sf)))


@query
def inventory_kpis(spark, sf):
    return kpis.inventory_kpis(cells.matched(_cells(spark, sf)))


@query
def inventory_kpis_priced(spark, sf):
    """Stock valued with a product dimension in place of the placeholder cost."""
    products = tables.product_dimension(spark, sf)
    return kpis.inventory_kpis(cells.matched(_cells(spark, sf), products))


@query
def regional_kpis(spark, sf):
    return kpis.regional_kpis(cells.matched(_cells(spark, sf)))


@query
def regional_kpis_exact(spark, sf):
    return kpis.regional_kpis_exact(cells.matched(_cells(spark, sf)))


@query
def processing_metrics(spark, sf):
    return kpis.processing_metrics(_cells(spark, sf))
