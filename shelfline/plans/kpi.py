"""Daily figures from silver, for all days of the run at once."""

from __future__ import annotations

from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.config import RunConfig, staged
from shelfline.model import INVENTORY_KPI, PROCESSING_DATE, REGIONAL_KPI, SALES_KPI
from shelfline.operators import cells, enrich, kpis, status
from shelfline.plans.batch import log_status, store_outcome, together
from shelfline.plans.claims import claim_days
from shelfline.plans.days import isolate_days
from shelfline.session import prepare
from shelfline.sinks.tables import quarantine, replace_dates
from shelfline.sources.silver import scan_silver


class PartialFailure(RuntimeError):
    """Some days have no figures; the others are stored."""


def run_kpis(
    spark: SparkSession, cfg: RunConfig, products: DataFrame | None = None
) -> DataFrame:
    """Figures of all days at once; a day that cannot be run fails alone, and the log shows it."""
    prepare(spark)
    return isolate_days(
        lambda part: _run_kpis(spark, part, products),
        cfg,
        lambda part: log_status(spark, part, "kpi_job", status.FAILED),
    )


def _run_kpis(spark: SparkSession, cfg: RunConfig, products: DataFrame | None) -> DataFrame:
    """Match once, stage the cells, and take all four outputs and the outcome from them."""
    base, days = cfg.path("silver"), cfg.days
    inventory = scan_silver(spark, base, "inventory", cfg.start, cfg.end)
    pos = scan_silver(spark, base, "pos", cfg.start, cfg.end)
    both = cells.match_cells(cells.inventory_cells(inventory), cells.pos_cells(pos))
    with staged(both, "cells") as matches:
        joined = cells.matched(matches, products)
        figures = {
            SALES_KPI: kpis.sales_kpis(joined),
            INVENTORY_KPI: kpis.inventory_kpis(joined),
            REGIONAL_KPI: kpis.regional_kpis(joined),
        }
        result = outcome(spark, cfg, matches)
        unmatched = _of_complete_days(cells.failed(matches), result)
        together(
            spark,
            *[partial(_store, cfg, name, df) for name, df in figures.items()],
            lambda: quarantine(
                unmatched, cfg.path("errors", "kpi"), "failed_joins", cfg.run_id, days, "failed_joins"
            ),
        )
        stored = store_outcome(result, cfg, "kpi")
    log_status(spark, cfg, "kpi_job", status.COMPLETED)
    return stored


def ready_days(spark: SparkSession, base: str) -> list[date]:
    """Days that the log shows ready for figures, in order. A row per day of the calendar."""
    log = spark.read.parquet(f"{base.rstrip('/')}/runs/log")
    ready = status.ready_for_kpis(status.current_status(log)).select(PROCESSING_DATE)
    return [day for (day,) in ready.distinct().orderBy(PROCESSING_DATE).collect()]


def ranges_of(days: list[date]) -> list[tuple[date, date]]:
    """Days in order as ranges of consecutive days."""
    ranges: list[tuple[date, date]] = []
    for day in days:
        if ranges and day - ranges[-1][1] == timedelta(1):
            ranges[-1] = (ranges[-1][0], day)
        else:
            ranges.append((day, day))
    return ranges


def run_ready(
    spark: SparkSession, base: str, run_id: str, claim_hours: float = 24
) -> list[DataFrame]:
    """Figures of all days that are ready and that no other run has claimed; an outcome per
    range of consecutive days.

    Runs that look at the same time share the days out among them: each is computed once.
    A range that fails does not keep the later ones from being run.
    """
    mine = claim_days(spark, base, "kpi", ready_days(spark, base), run_id, claim_hours)
    outcomes, failed = [], []
    for first, last in ranges_of(mine):
        try:
            outcomes.append(run_kpis(spark, RunConfig(base, first, last, run_id)))
        except Exception as error:
            failed.append(error)
    if failed:
        raise failed[0]
    return outcomes


def _store(cfg: RunConfig, name: str, figures: DataFrame) -> None:
    stamped = enrich.audit(figures, cfg.run_id, "kpi_creation_timestamp")
    replace_dates(stamped, cfg.path("kpi", name), cfg.days)


def _of_complete_days(failed: DataFrame, result: DataFrame) -> DataFrame:
    """Unmatched cells of days that have rows on both sides; a day missing one is skipped."""
    sides = (F.col("inventory_records_read") > 0) & (F.col("pos_records_read") > 0)
    return failed.join(result.filter(sides), PROCESSING_DATE, "left_semi")


def outcome(spark: SparkSession, cfg: RunConfig, matches: DataFrame) -> DataFrame:
    """Counts and status of every day of the run."""
    counted = status.run_outcome(status.run_days(spark, cfg), kpis.processing_metrics(matches))
    return counted.withColumn(
        "status",
        status.kpi_status(
            F.col("inventory_records_read"), F.col("pos_records_read"), F.col("joined_records")
        ),
    )


def raise_on_partial_failure(outcomes: DataFrame) -> None:
    """Fail the job after all days were tried, naming those without figures."""
    bad = outcomes.filter(F.col("status") != status.SUCCESS).select(PROCESSING_DATE).collect()
    if bad:
        raise PartialFailure(f"no figures for: {sorted(str(r[0]) for r in bad)}")
