"""The stored tables by name, for SQL."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from shelfline.model import INVENTORY_KPI, REGIONAL_KPI, SALES_KPI

# Table name -> folder under the base path.
TABLES = {
    "pos_daily": "silver/pos",
    "inventory_daily": "silver/inventory",
    SALES_KPI: f"kpi/{SALES_KPI}",
    INVENTORY_KPI: f"kpi/{INVENTORY_KPI}",
    REGIONAL_KPI: f"kpi/{REGIONAL_KPI}",
}


def register_tables(spark: SparkSession, base: str) -> list[str]:
    """Make the tables that exist under ``base`` known to the session; returns their names."""
    for name, folder in TABLES.items():
        try:
            df = spark.read.parquet(f"{base.rstrip('/')}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue  # not written yet
        df.createOrReplaceTempView(name)
    known = {t.name for t in spark.catalog.listTables()}
    return sorted(known & set(TABLES))
