"""Whole jobs over many days, their tables read back, and status decisions."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import functions as F

from shelfline.config import RunConfig, new_shared_path
from shelfline.model import INVENTORY, INVENTORY_KPI, POS, PROCESSING_DATE, REGIONAL_KPI, SALES_KPI
from shelfline.operators import status
from shelfline.plans.batch import run_batch, run_landed
from shelfline.plans.claims import claim_days
from shelfline.plans.kpi import ranges_of, ready_days, run_kpis
from shelfline.queries.registry import query, query_named
from shelfline.sinks.tables import replace_dates
from shelfline.sources import tables
from shelfline.sources.silver import scan_silver


def _config(spark, sf):
    """The tables' days and one day more, which has no rows."""
    events = tables.table(spark, sf, "events")
    first, last = events.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    return RunConfig(new_shared_path(spark, "lake"), first, last + timedelta(1))


def _run(spark, sf):
    cfg = _config(spark, sf)
    pos = run_batch(spark, tables.pos_raw(spark, sf), POS, cfg)
    inventory = run_batch(spark, tables.inventory_raw(spark, sf), INVENTORY, cfg)
    return cfg, pos, inventory, run_kpis(spark, cfg)


def _without_audit(df):
    added = ["job_run_id", "kpi_creation_timestamp"]
    return df.drop(*added, "processed_timestamp_utc", "redshift_load_timestamp")


@query
def backfill_dates(spark, sf):
    """Every day between the first and last event, with its rows."""
    events = tables.table(spark, sf, "events").select(F.to_date("ts").alias(PROCESSING_DATE))
    bounds = events.agg(F.min(PROCESSING_DATE).alias("lo"), F.max(PROCESSING_DATE).alias("hi"))
    rows = events.groupBy(PROCESSING_DATE).agg(F.count(F.lit(1)).alias("rows"))
    return status.run_outcome(status.days_between(bounds, "lo", "hi"), rows)


@query
def backfill_status(spark, sf):
    """Outcome of every day of a run over all three jobs."""
    _, pos, inventory, figures = _run(spark, sf)
    return pos.join(inventory, PROCESSING_DATE).join(figures, PROCESSING_DATE)


@query
def silver_roundtrip(spark, sf):
    cfg = _config(spark, sf)
    run_batch(spark, tables.pos_raw(spark, sf), POS, cfg)
    return _without_audit(scan_silver(spark, cfg.path("silver"), "pos", cfg.start, cfg.end))


@query
def daily_runs(spark, sf):
    """Three runs over one landing folder that holds ever more days; each opens its own files."""
    cfg = _config(spark, sf)
    landing = f"{cfg.base}/landing"
    third = (cfg.end - cfg.start) // 3
    first = cfg.start
    for last in (cfg.start + third, cfg.start + 2 * third, cfg.end):
        rows = tables.pos_raw(spark, sf).filter(F.col("partition_date").between(first, last))
        named = rows.withColumn("file", F.concat("partition_date", F.lit("_sales.csv")))
        writer = named.drop("partition_date").write.mode("append").partitionBy("file")
        writer.option("header", True).csv(landing)
        part = replace(cfg, start=first, end=last)
        run_landed(spark, POS, landing, part)
        first = last + timedelta(1)
    return _without_audit(scan_silver(spark, cfg.path("silver"), "pos", cfg.start, cfg.end))


@query
def logged_readiness(spark, sf):
    """Ranges of days ready by the log that the jobs wrote: sales of all days are in, stock
    readings of the first half."""
    cfg = _config(spark, sf)
    half = replace(cfg, end=cfg.start + (cfg.end - cfg.start) // 2)
    run_batch(spark, tables.pos_raw(spark, sf), POS, cfg)
    run_batch(spark, tables.inventory_raw(spark, sf), INVENTORY, half)
    schema = "first_day date, last_day date"
    return spark.createDataFrame(ranges_of(ready_days(spark, cfg.base)), schema)


@query
def inventory_roundtrip(spark, sf):
    cfg = _config(spark, sf)
    run_batch(spark, tables.inventory_raw(spark, sf), INVENTORY, cfg)
    return _without_audit(
        scan_silver(spark, cfg.path("silver"), "inventory", cfg.start, cfg.end)
    )


@query_named("quarantine")
def quarantine_roundtrip(spark, sf):
    """Rejects of two runs over the same days: the second leaves those of the first."""
    cfg = _config(spark, sf)
    for run_id in ("first", "second"):
        run_batch(spark, tables.pos_raw(spark, sf), POS, replace(cfg, run_id=run_id))
    schema = """transaction_id string, store_id int, product_id int, quantity int,
        revenue float, discount_applied float, `timestamp` bigint, error_reason string,
        processing_date_of_error date, source_type string, job_run_id string,
        processing_date date"""
    return spark.read.schema(schema).json(cfg.path("errors", "validation"))


@query_named("write_kpi_sales")
def sales_kpi_table(spark, sf):
    cfg, *_ = _run(spark, sf)
    return _without_audit(spark.read.parquet(cfg.path("kpi", SALES_KPI)))


@query_named("write_kpi_inventory")
def inventory_kpi_table(spark, sf):
    cfg, *_ = _run(spark, sf)
    return _without_audit(spark.read.parquet(cfg.path("kpi", INVENTORY_KPI)))


@query_named("write_kpi_regional")
def regional_kpi_table(spark, sf):
    cfg, *_ = _run(spark, sf)
    return _without_audit(spark.read.parquet(cfg.path("kpi", REGIONAL_KPI)))


@query
def replace_by_date(spark, sf):
    """All days are stored, then the later half again: doubled, and the last day now empty."""
    first, last = tables.table(spark, sf, "events").agg(
        F.min("ts").cast("date"), F.max("ts").cast("date")
    ).first()
    half = first + (last - first) // 2
    day = F.col(PROCESSING_DATE)
    rows = tables.pos_raw(spark, sf).withColumnRenamed("partition_date", PROCESSING_DATE)
    path = new_shared_path(spark, "replaced")
    replace_dates(rows, path, RunConfig("", first, last).days)
    again = rows.filter((day > F.lit(half)) & (day < F.lit(last)))
    doubled = again.withColumn("quantity", F.col("quantity") * 2)
    replace_dates(doubled, path, RunConfig("", half + timedelta(1), last).days)
    return spark.read.schema(rows.schema).parquet(path)


@query
def status_upsert(spark, sf):
    return status.current_status(tables.status_events(spark, sf))


@query
def kpi_readiness(spark, sf):
    """Days ready for figures if no figures had been started yet, and those still ready."""
    current = status.current_status(tables.status_events(spark, sf))
    fresh = current.withColumn("kpi_job_triggered", F.lit(None).cast("boolean"))
    still = status.ready_for_kpis(current).select(PROCESSING_DATE, F.lit(True).alias("still"))
    return (
        status.ready_for_kpis(fresh)
        .select(PROCESSING_DATE)
        .join(still, PROCESSING_DATE, "left")
        .fillna(False)
    )


@query
def claimed_days(spark, sf):
    """Days with both transforms completed, wanted by four runs at once, and how many got each."""
    current = status.current_status(tables.status_events(spark, sf))
    fresh = current.withColumn("kpi_job_triggered", F.lit(False))
    days = [day for (day,) in status.ready_for_kpis(fresh).select(PROCESSING_DATE).collect()]
    base = new_shared_path(spark, "claims")

    def gate(n):
        return [(day, f"run{n}") for day in claim_days(spark, base, "kpi", days, f"run{n}")]

    with ThreadPoolExecutor(4) as pool:
        got = [claim for claims in pool.map(gate, range(4)) for claim in claims]
    claims = spark.createDataFrame(got, f"{PROCESSING_DATE} date, run_id string")
    return claims.groupBy(PROCESSING_DATE).agg(F.count_distinct("run_id").alias("runs"))


@query
def days_to_compute(spark, sf):
    """Days with sign-ups and purchases, of which the earlier half has figures already."""
    events = tables.table(spark, sf, "events").withColumn(PROCESSING_DATE, F.to_date("ts"))
    middle = events.agg(F.median(F.unix_date(PROCESSING_DATE)).alias("middle")).first().middle
    return status.days_to_compute(
        events.filter("event_type = 'purchase'"),
        events.filter("event_type = 'signup'"),
        events.filter(F.unix_date(PROCESSING_DATE) < F.lit(middle)),
    )
