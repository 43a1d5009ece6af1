"""Raw batch files. Everything is read as text and typed by the lenient cast afterwards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.model import INVENTORY, PROCESSING_DATE

PARTITION_DATE = "partition_date"
FILE_DATE = "_file_date"
UNDATED = "_undated"
BROKEN_LINE = "_corrupt_record"


def scan_pos_raw(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """CSV with a header line. Columns go by the header, so a missing one is seen.

    ``files`` are those of the folder to read, else all are."""
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.[cC][sS][vV]")
    return reader.csv(path) if files is None else reader.option("basePath", path).csv(files)


def scan_inventory_raw(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    infer: bool = False,
    files: list[str] | None = None,
) -> DataFrame:
    """JSON Lines. Numbers are kept as the text they were written with.

    Columns are the declared ones, and a folder's ``partition_date``. ``infer`` takes the
    fields found instead, at the price of another pass, so that one missing from all files
    is seen as missing rather than as NULL everywhere; the text of lines that are no JSON
    is then kept in ``_corrupt_record``. ``files`` are those of the folder to read, else all.
    """
    reader = spark.read if files is None else spark.read.option("basePath", path)
    if infer:
        return reader.option("primitivesAsString", True).json(path if files is None else files)
    names = columns or INVENTORY.columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return reader.schema(schema).json(path if files is None else files)


def file_day(path: Column) -> Column:
    """The day that a file's path, or the folder it is written as, names; NULL if none.

    Names begin with the day and an underscore, or hold eight digits between underscores,
    the start, and a dot.
    """
    folder = F.regexp_extract(path, r"(?:/|=)(\d{4}-\d{2}-\d{2})_[^/]*(?:/[^/]*)?$", 1)
    digits = F.regexp_extract(path, r"(?:/|_)(\d{8})[_.][^/]*$", 1)
    day = F.coalesce(
        F.try_to_timestamp(F.when(folder != "", folder), F.lit("yyyy-MM-dd")),
        F.try_to_timestamp(F.when(digits != "", digits), F.lit("yyyyMMdd")),
    )
    return day.cast("date")


def with_file_date(scan: DataFrame) -> DataFrame:
    """Add the day that a row's file names; NULL if none."""
    return scan.withColumn(FILE_DATE, file_day(F.col("_metadata.file_path")))


def for_days(df: DataFrame, start: date, end: date) -> DataFrame:
    """Rows of the run's days, and those of no known day, marked as such.

    A row's day is its ``partition_date``, else that of its file. Only the run's folders are
    read where the date partitions them. A frame with neither column belongs to the run's
    day, which only a run of a single day can mean.
    """
    named = [c for c in (PARTITION_DATE, FILE_DATE) if c in df.columns]
    if named:
        day = F.coalesce(*(F.col(c).try_cast("date") for c in named))
        return (
            df.filter(day.isNull() | day.between(F.lit(start), F.lit(end)))
            .withColumn(PROCESSING_DATE, F.coalesce(day, F.lit(start)))
            .withColumn(UNDATED, day.isNull())
            .drop(*named)
        )
    if start != end:
        raise ValueError(f"a run over several days needs a {PARTITION_DATE} column")
    return df.withColumn(PROCESSING_DATE, F.lit(start))
