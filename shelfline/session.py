"""Session settings the jobs rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Dates and two-hour buckets are defined in UTC. A JSON object naming a key twice keeps
# the last value, as common parsers do, instead of being refused.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", name: str = "shelfline") -> SparkSession:
    """A single-machine session for tests and the bench."""
    partitions = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
