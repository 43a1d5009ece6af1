"""Days of a run, their outcome, and the pipeline's status per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.config import RunConfig
from shelfline.model import PROCESSING_DATE
from shelfline.operators.validate import REASON

SUCCESS = "SUCCESS"
PARTIAL_FAILURE = "PARTIAL_FAILURE"
COMPLETED = "COMPLETED"
FAILED = "FAILED"


def run_days(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """The run's days, both ends included, one row each."""
    bounds = F.sequence(F.lit(cfg.start), F.lit(cfg.end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(bounds).alias(PROCESSING_DATE))


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """The same over bounds that are themselves data."""
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(PROCESSING_DATE))


def feed_outcome(checked: DataFrame, silver: DataFrame, prefix: str) -> DataFrame:
    """Per day: rows in, valid, invalid and kept. Both inputs are folded per day first."""
    seen = checked.groupBy(PROCESSING_DATE).agg(
        F.count(F.lit(1)).alias(f"{prefix}_rows_in"),
        F.count_if(F.col(REASON).isNull()).alias(f"{prefix}_valid"),
        F.count_if(F.col(REASON).isNotNull()).alias(f"{prefix}_invalid"),
    )
    kept = silver.groupBy(PROCESSING_DATE).agg(F.count(F.lit(1)).alias(f"{prefix}_kept"))
    return seen.join(kept, PROCESSING_DATE, "left")


def run_outcome(days: DataFrame, *parts: DataFrame) -> DataFrame:
    """Every day of the run with the counts of all parts; a day without data has zeros."""
    out = days
    for part in parts:
        out = out.join(part, PROCESSING_DATE, "left")
    return out.fillna(0, [c for c in out.columns if c != PROCESSING_DATE])


def kpi_status(inventory_rows: Column, pos_rows: Column, joined: Column) -> Column:
    """A day with an empty side or no matched cell is a partial failure."""
    return F.when((inventory_rows > 0) & (pos_rows > 0) & (joined > 0), SUCCESS).otherwise(
        PARTIAL_FAILURE
    )


def current_status(events: DataFrame) -> DataFrame:
    """Latest status per day from the append-only log (step, status, at, execution_name).

    Setting a field again replaces it, so the last event per day and step counts. Partial
    aggregation folds each day before the shuffle.
    """

    def latest(value: str, step: str) -> Column:
        order = F.when(F.col("step") == step, F.struct("at", "execution_name"))
        return F.max_by(value, order)

    return events.groupBy(PROCESSING_DATE).agg(
        latest("status", "pos_transform").alias("pos_transform_status"),
        latest("at", "pos_transform").alias("pos_transform_timestamp"),
        latest("execution_name", "pos_transform").alias("execution_name_pos"),
        latest("status", "inventory_transform").alias("inventory_transform_status"),
        latest("at", "inventory_transform").alias("inventory_transform_timestamp"),
        latest("execution_name", "inventory_transform").alias("execution_name_inventory"),
        F.count_if(F.col("step") == "kpi_job").cast("boolean").alias("kpi_job_triggered"),
        latest("at", "kpi_job").alias("kpi_trigger_timestamp"),
    )


def ready_for_kpis(status: DataFrame) -> DataFrame:
    """Days with both transforms completed and the figures not yet started."""
    triggered = F.coalesce(F.col("kpi_job_triggered"), F.lit(False))
    return status.filter(
        (F.col("pos_transform_status") == COMPLETED)
        & (F.col("inventory_transform_status") == COMPLETED)
        & ~triggered
    )


def days_to_compute(pos: DataFrame, inventory: DataFrame, kpi: DataFrame) -> DataFrame:
    """The same decision from the tables: days in both silver tables without figures yet."""
    day = [PROCESSING_DATE]
    both = pos.select(*day).distinct().join(inventory.select(*day).distinct(), day)
    return both.join(kpi.select(*day).distinct(), day, "left_anti")
