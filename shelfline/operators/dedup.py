"""Keep the latest copy of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key: the latest by ``order_by``, ties decided by the other columns.

    The ``rn == 1`` shape lets Spark cut every map partition to one row per key before the
    shuffle, so a key holding a third of all rows sends one row per map task, not its rows.
    """
    rest = [c for c in df.columns if c not in keys and c != order_by]
    newest = [F.col(c).desc_nulls_last() for c in [order_by, *rest]]
    ranked = df.withColumn(
        "rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    )
    return ranked.filter(F.col("rn") == 1).drop("rn")


def dedup_report(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows before and after, and the duplicates removed.

    Counting per key first means a hot key is folded before the shuffle.
    """
    per_key = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates_removed"),
    )
