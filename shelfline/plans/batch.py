"""One feed from raw files to silver, for all days of the run at once."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.config import RunConfig, staged
from shelfline.model import NO_DAY, PROCESSING_DATE, Feed
from shelfline.operators import dedup, enrich, status, validate
from shelfline.plans.days import isolate_days
from shelfline.session import prepare
from shelfline.sinks.tables import quarantine, replace_dates
from shelfline.sources.landing import (
    archive_of,
    as_path,
    files_to_take,
    move_to_archive,
    remember,
    scan_files,
)
from shelfline.sources.raw import BROKEN_LINE, UNDATED, for_days
from shelfline.sources.silver import scan_silver

_LOG = logging.getLogger(__name__)

# Per feed: enrichment, the time the latest copy goes by, and the load time's column.
_LAYOUT = {
    "pos": (enrich.enrich_pos, "transaction_timestamp", "processed_timestamp_utc"),
    "inventory": (enrich.enrich_inventory, "last_updated", "redshift_load_timestamp"),
}


_GOOD = "_good"
RAW_LINE = "raw_line"


class MissingColumns(ValueError):
    """The raw frame lacks required columns; all its rows are in quarantine."""


def to_silver(valid: DataFrame, feed: Feed) -> DataFrame:
    """Enrich, then keep the latest copy per day and key."""
    enriched, order_by, _ = _LAYOUT[feed.name]
    return dedup.latest_per_key(enriched(valid), [PROCESSING_DATE, feed.key], order_by)


def run_batch(spark: SparkSession, raw: DataFrame, feed: Feed, cfg: RunConfig) -> DataFrame:
    """Check, quarantine, enrich, de-duplicate, store. Returns the stored outcome per day.

    A day that cannot be run fails alone, and the log shows it. Only rows of the run's days are taken, whatever else lies in the raw folder; rows of no
    known day go to quarantine. The raw text is parsed once: checked rows are staged, good
    and bad in folders of their own, and quarantine, silver and counts read from there.
    """
    prepare(spark)
    return _by_days(spark, feed, cfg, lambda part: _run_batch(spark, raw, feed, part))


def _by_days(
    spark: SparkSession, feed: Feed, cfg: RunConfig, run: Callable[[RunConfig], DataFrame]
) -> DataFrame:
    step = f"{feed.name}_transform"
    return isolate_days(run, cfg, lambda part: log_status(spark, part, step, status.FAILED))


def _run_batch(spark: SparkSession, raw: DataFrame, feed: Feed, cfg: RunConfig) -> DataFrame:
    days = cfg.days
    source = for_days(raw, cfg.start, cfg.end)
    missing = validate.missing_columns(source, feed)
    errors = cfg.path("errors", "validation")
    if missing:
        quarantine(validate.check(source, feed), errors, feed.name, cfg.run_id, days)
        raise MissingColumns(validate.missing_reason(missing))

    with staged(_checked(source, feed), f"{feed.name}-checked", by=(_GOOD,)) as checked:
        rejected = checked.filter(~F.col(_GOOD)).drop(_GOOD)
        valid = validate.valid_rows(checked.filter(_GOOD)).drop(_GOOD, RAW_LINE)
        silver = to_silver(valid, feed)
        stamped = enrich.audit(silver, cfg.run_id, _LAYOUT[feed.name][2])
        together(
            spark,
            lambda: quarantine(rejected, errors, feed.name, cfg.run_id, days),
            lambda: replace_dates(stamped, cfg.path("silver", feed.name), days),
        )
        kept = scan_silver(spark, cfg.path("silver"), feed.name, cfg.start, cfg.end)
        outcome = status.run_outcome(
            status.run_days(spark, cfg), status.feed_outcome(checked, kept, feed.name)
        )
        stored = store_outcome(outcome, cfg, feed.name)
    log_status(spark, cfg, f"{feed.name}_transform", status.COMPLETED)
    return stored


def run_landed(
    spark: SparkSession, feed: Feed, landing: str, cfg: RunConfig, archive: str | None = None
) -> DataFrame:
    """Run a feed on a landing folder, opening only the files that the run takes.

    Which those are is told by their names and the files of finished runs; a run's file names
    reach the driver, as those of any file scan do. A file that cannot be read fails its own
    day; one of no day fails all. Files of days that are stored move to ``archive``, if given,
    from where a later run of such a day reads them again.
    """
    prepare(spark)
    return _by_days(spark, feed, cfg, lambda part: _run_landed(spark, feed, landing, part, archive))


def _run_landed(
    spark: SparkSession, feed: Feed, landing: str, cfg: RunConfig, archive: str | None
) -> DataFrame:
    kept = archive_of(spark, feed, landing, archive) if archive else None
    with staged(files_to_take(spark, feed, landing, cfg, archive), f"{feed.name}-files") as taken:
        files = taken.select("file", "day", as_path(F.col("file")).alias("name")).collect()
        old = [f for f in files if kept and f.file.startswith(f"{kept}/")]
        new = [f for f in files if not (kept and f.file.startswith(f"{kept}/"))]
        roots = [(landing, new), *([(kept, old)] if old else [])]
        scans = [
            scan_files(spark, feed, root, sorted(f.name for f in part))
            for root, part in roots
            if part or not old
        ]
        raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
        outcome = _run_batch(spark, raw, feed, cfg)
        remember(taken, feed, cfg)
    if kept:
        left = move_to_archive(spark, [f.file for f in new if f.day], landing, kept)
        if left:
            _LOG.warning("%d files are not in the archive, among them %s", len(left), left[:20])
    return outcome


def _checked(source: DataFrame, feed: Feed) -> DataFrame:
    """Checked rows with the text of broken lines, and whether a row is good."""
    carry = [c for c in (PROCESSING_DATE, UNDATED, BROKEN_LINE) if c in source.columns]
    checked = validate.check(source, feed, carry)
    if UNDATED in carry:
        why = F.when(F.col(UNDATED), NO_DAY).otherwise(F.col(validate.REASON))
        checked = checked.withColumn(validate.REASON, why).drop(UNDATED)
    # A reader of JSON takes the source's name for its own.
    checked = checked.withColumnRenamed(BROKEN_LINE, RAW_LINE)
    return checked.withColumn(_GOOD, F.col(validate.REASON).isNull())


def log_status(spark: SparkSession, cfg: RunConfig, step: str, state: str) -> None:
    """Add the step's state for every day of the run to the log."""
    rows = status.run_days(spark, cfg).select(
        PROCESSING_DATE,
        F.lit(step).alias("step"),
        F.lit(state).alias("status"),
        F.current_timestamp().alias("at"),
        F.lit(cfg.run_id).alias("execution_name"),
    )
    rows.coalesce(1).write.mode("append").parquet(cfg.path("runs", "log"))


def together(spark: SparkSession, *actions: Callable[[], object]) -> None:
    """Run independent writes at the same time, so that small ones share the cluster."""
    with ThreadPoolExecutor(len(actions)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(a)) for a in actions]:
            done.result()


def store_outcome(outcome: DataFrame, cfg: RunConfig, job: str) -> DataFrame:
    """Keep the run's outcome, one row per day, under its run id and first day, and read it back.

    A run whose days were taken in parts has one part for each.
    """
    path = cfg.path("runs", job, f"job_run_id={cfg.run_id}", f"first_day={cfg.start}")
    outcome.write.mode("overwrite").parquet(path)
    return outcome.sparkSession.read.schema(outcome.schema).parquet(path)
