"""Two-hour sales cells of a stream: the batch aggregation, batch by batch.

Every batch writes what its rows add to the cells, and puts rows later than the watermark
aside in ``errors/late``. Both lie below the batch's id, so that a repeated batch replaces
itself. The watermark is the largest time of earlier batches less the lateness, as stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.columns import time_bucket

_CELL = ["product_id", "analysis_date", "time_bucket"]
_NO_CELLS = """product_id int, analysis_date date, time_bucket bigint, total_quantity bigint,
    total_revenue double, total_discount double, transaction_count bigint,
    store_list array<int>, pos_timestamp timestamp"""


class LateRows(RuntimeError):
    """Rows came later than the watermark allows; they are in ``errors/late``."""


def _cells(pos: DataFrame) -> DataFrame:
    """Sums per product and two-hour window of ``transaction_timestamp``."""
    opened = F.col("window.start")
    return (
        pos.groupBy("product_id", F.window("transaction_timestamp", "2 hours"))
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("discount_applied").alias("total_discount"),
            F.count("transaction_id").alias("transaction_count"),
            F.array_sort(F.collect_set("store_id")).alias("store_list"),
            F.max("transaction_timestamp").alias("pos_timestamp"),
        )
        .select(
            "product_id",
            F.to_date(opened).alias("analysis_date"),
            time_bucket(opened).alias("time_bucket"),
            "total_quantity",
            "total_revenue",
            "total_discount",
            "transaction_count",
            "store_list",
            "pos_timestamp",
        )
    )


def run_cells(pos: DataFrame, out: str, checkpoint: str, lateness: str = "2 hours") -> None:
    """Work off what is there and stop. Every batch writes what it adds to the cells.

    Windows need not be closed to be written, so none is missing at the end of a run. Rows
    whose window ended before the watermark go to ``errors/late``; the run then fails at its
    end and tells how many there were.
    """
    top, late = None, 0  # the largest time in microseconds, the number of late rows
    largest = F.unix_micros(F.max("pos_timestamp"))

    def batch(df: DataFrame, n: int) -> None:
        nonlocal top, late
        spark = df.sparkSession
        if top is None and n > 0:
            top = _added(spark, out).filter(F.col("batch_id") < n).agg(largest).first()[0]
        mark = F.timestamp_micros(F.lit(top).cast("long")) - F.expr(f"INTERVAL {lateness}")
        ended = F.window("transaction_timestamp", "2 hours")["end"] <= mark
        rows = df.withColumn("is_late", F.coalesce(ended, F.lit(False))).persist()
        try:
            kept, aside = f"{out}/cells/batch_id={n}", f"{out}/errors/late/batch_id={n}"
            _cells(rows.filter("NOT is_late")).write.mode("overwrite").parquet(kept)
            rows.filter("is_late").drop("is_late").write.mode("overwrite").parquet(aside)
        finally:
            rows.unpersist()
        tops = [top, spark.read.parquet(kept).agg(largest).first()[0]]
        top = max((t for t in tops if t is not None), default=None)
        late += spark.read.parquet(aside).count()

    query = (
        pos.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if late:
        raise LateRows(f"{late} rows were later than {lateness}; they are in {out}/errors/late")


def _added(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.option("basePath", f"{out}/cells").parquet(f"{out}/cells/batch_id=*")


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """Rows that were put aside, with the batch they came in."""
    aside = f"{out}/errors/late"
    return spark.read.option("basePath", aside).parquet(f"{aside}/batch_id=*")


def _written(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def latest_cells(spark: SparkSession, out: str) -> DataFrame:
    """Each cell with all that batches added to it, late rows included; none before a batch."""
    added, late = _written(lambda: _added(spark, out)), _written(lambda: late_rows(spark, out))
    if added is None:
        return spark.createDataFrame([], _NO_CELLS)
    added = added.drop("batch_id")
    if late is not None:  # a batch that is cut short has written its cells first
        added = added.unionByName(_cells(late))
    return added.groupBy(*_CELL).agg(
        *[F.sum(c).alias(c) for c in ("total_quantity", "total_revenue", "total_discount", "transaction_count")],
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("store_list")))).alias("store_list"),
        F.max("pos_timestamp").alias("pos_timestamp"),
    )
