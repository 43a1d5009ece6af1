"""Entry point for spark-submit; see shelfline/cli.py."""

import sys

from pyspark.sql import SparkSession

from shelfline.cli import run

if __name__ == "__main__":
    spark = SparkSession.builder.appName("shelfline").getOrCreate()
    outcome = run(spark, sys.argv[1:])
    if outcome is not None:
        outcome.orderBy("processing_date").show(400, truncate=False)
    spark.stop()
