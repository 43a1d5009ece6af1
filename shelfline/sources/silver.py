"""Silver tables, read from their base path so that dates prune folders."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.model import PROCESSING_DATE

# The silver layouts.
SILVER_SCHEMAS = {
    "pos": """transaction_id string, store_id int, product_id int, quantity int,
        revenue float, discount_applied float, `timestamp` bigint,
        transaction_timestamp timestamp, sale_category string,
        processed_timestamp_utc timestamp, job_run_id string, processing_date date""",
    "inventory": """inventory_id int, product_id int, warehouse_id int, stock_level int,
        restock_threshold int, last_updated timestamp, stock_status string,
        processing_date date, job_run_id string, redshift_load_timestamp timestamp""",
}


def scan_silver(
    spark: SparkSession, base: str, source: str, start: date, end: date
) -> DataFrame:
    """Rows of the given days; empty when the table was never written."""
    if source not in SILVER_SCHEMAS:
        raise ValueError(f"unknown silver source: {source}")
    schema = SILVER_SCHEMAS[source]
    try:
        df = spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{source}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    return df.filter(F.col(PROCESSING_DATE).between(F.lit(start), F.lit(end)))
