"""Date-partitioned tables that can be rerun: a run replaces exactly its own days."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfline.model import PROCESSING_DATE


def _by_date(df: DataFrame, path: str, fmt: str) -> None:
    # Rebalancing gathers a day into few files and still splits a day too big for one task.
    (
        df.hint("rebalance", F.col(PROCESSING_DATE))
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PROCESSING_DATE)
        .save(path)
    )


def replace_dates(df: DataFrame, path: str, days: Iterable[date], fmt: str = "parquet") -> None:
    """Replace the given days of the table by the rows of ``df``, in one write.

    A day of the run without rows ends up empty instead of keeping what an earlier run left.
    """
    written = Observation()
    seen = F.collect_set(F.col(PROCESSING_DATE).cast("string")).alias("days")
    _by_date(df.observe(written, seen), path, fmt)
    try:
        present = set(written.get["days"])
    except Py4JJavaError:  # a frame known to be empty is optimized away, observation and all
        if not df.isEmpty():
            raise
        present = set()
    absent = [day for day in days if day.isoformat() not in present]
    if not absent:
        return
    stored = df.sparkSession.read.schema(df.schema).format(fmt).load(path)
    stale = stored.filter(F.col(PROCESSING_DATE).isin(absent)).select(PROCESSING_DATE)
    empty = df.limit(0).drop(PROCESSING_DATE)
    for (day,) in stale.distinct().collect():
        leaf = f"{path}/{PROCESSING_DATE}={day.isoformat()}"
        empty.write.format(fmt).mode("overwrite").save(leaf)


def quarantine(
    rows: DataFrame,
    path: str,
    source_type: str,
    run_id: str,
    days: Iterable[date],
    error_type: str | None = None,
) -> None:
    """Rejected rows as JSON with when and for which day, per source, run and day.

    A run replaces what the same run wrote before; other runs' rows stay.
    """
    added = {
        "error_timestamp_utc": F.current_timestamp(),
        "processing_date_of_error": F.col(PROCESSING_DATE),
    }
    if error_type:
        added["error_type"] = F.lit(error_type)
    own = f"{path}/source_type={source_type}/job_run_id={run_id}"
    replace_dates(rows.withColumns(added), own, days, "json")
