"""The latest copy of each key, of rows that come as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.operators.dedup import latest_per_key

_ARRIVED = "_arrived"


def run_latest(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: str,
    out: str,
    checkpoint: str,
    horizon: str = "2 hours",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store the latest copy of each key, batch by batch; by default work off what is there.

    Exact copies that arrive within ``horizon`` of each other are dropped by Spark's state
    store. Its watermark goes by the time of arrival, which is the batch's: so no row is ever
    late, however old its own time, and none is lost. Rows that differ under one key, and
    copies that arrive later, are settled in each batch and again when the table is read.
    """
    arrived = rows.withColumn(_ARRIVED, F.current_timestamp()).withWatermark(_ARRIVED, horizon)
    fresh = arrived.dropDuplicatesWithinWatermark(rows.columns).drop(_ARRIVED)

    def batch(df: DataFrame, n: int) -> None:
        latest = latest_per_key(df, keys, order_by)
        latest.write.mode("overwrite").parquet(f"{out}/batch_id={n}")

    return (
        fresh.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_rows(
    spark: SparkSession, out: str, schema, keys: Sequence[str], order_by: str
) -> DataFrame:
    """The latest copy of each key over all batches."""
    stored = spark.read.schema(schema).parquet(out).drop("batch_id")
    return latest_per_key(stored, keys, order_by)
