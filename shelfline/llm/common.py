"""Words, staged tables and SQL helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.config import new_shared_path, stage

#: What separates words in every contract of this subpackage.
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Later steps then read what was written, whatever executors are lost meanwhile. The
    folder goes when the driver ends.
    """
    return stage(df, new_shared_path(df.sparkSession, name))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def text_hash() -> Column:
    return F.xxhash64(F.col("text"))


def row_key(docs: DataFrame) -> Column:
    """A hash of all columns: rows that share it are the same in everything."""
    return F.xxhash64(*(docs[c] for c in docs.columns))


def repeated(docs: DataFrame, verdicts: DataFrame, chunk: int = 1000) -> DataFrame:
    """``docs``, each row as often as its verdict says.

    ``verdicts`` (doc_id, row_key, times) has a row for each row of ``docs``. Rows that are the
    same in all columns pool their times. One of them, found by partial aggregation, stands for
    all, and its copies are made ``chunk`` by ``chunk`` in different tasks, so that no task
    holds more, however often a row repeats.
    """
    totals = verdicts.groupBy(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")).agg(F.count("*").alias("_rows"), F.sum("times").alias("_total"))
    totals = staged(totals.filter("_total > 0"), "verdicts")
    keyed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), docs["doc_id"].alias("_doc"), row_key(docs).alias("_hash"))

    def found(some: DataFrame) -> DataFrame:
        return keyed.join(some, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key")))

    ones = found(totals.filter("_rows = 1")).select("_row", F.explode(F.sequence(F.lit(1), F.col("_total"))))
    alike = found(totals.filter("_rows > 1")).groupBy("_id", "_key").agg(F.first("_row").alias("_row"), F.first("_total").alias("_total"))
    chunks = alike.withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_total") - 1, F.lit(chunk)))).repartition("_id", "_key", "_at")
    some = chunks.select("_row", F.explode(F.sequence(F.lit(1), F.least(F.lit(chunk), F.col("_total") - F.col("_at")))))
    return ones.union(some).select("_row.*")
