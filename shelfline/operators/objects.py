"""Decisions about arriving files, as columns over their object keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.model import Feed

# Landing folders and routes.
POS_LANDING = "raw/batch/pos-raw/"
INVENTORY_LANDING = "raw/batch/inventory-raw/"
LANDING = {"pos": POS_LANDING, "inventory": INVENTORY_LANDING}


def file_name(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def path_metadata(df: DataFrame, key: str = "object_key") -> DataFrame:
    """data_type (first folder), file_extension (after the last dot) and processing_date
    (second path part up to its first underscore)."""
    k = F.col(key)
    return df.withColumns(
        {
            "data_type": F.split_part(k, F.lit("/"), F.lit(1)),
            "file_extension": F.element_at(F.split(k, r"\."), -1),
            "processing_date": F.split_part(
                F.split_part(k, F.lit("/"), F.lit(2)), F.lit("_"), F.lit(1)
            ),
        }
    )


def route_by_type(described: DataFrame) -> DataFrame:
    """Add ``route``: pos for POS CSV, inventory for inventory JSON, else invalid_input."""
    kind, ext = F.col("data_type"), F.col("file_extension")
    return described.withColumn(
        "route",
        F.when((kind == "pos") & (ext == "csv"), "pos")
        .when((kind == "inventory") & (ext == "json"), "inventory")
        .otherwise("invalid_input"),
    )


def decoded_key(key: Column) -> Column:
    """Percent escapes and plus signs undone; a percent sign that begins none stays."""
    return F.url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25"))


def land_csv(df: DataFrame, key: str = "object_key", target: str = POS_LANDING) -> DataFrame:
    """Per key: is it skipped, already in place, or to be landed, and where."""
    source = decoded_key(F.col(key))
    is_csv = F.lower(source).endswith(".csv")
    in_place = source.startswith(target)
    status = (
        F.when(~is_csv, "skipped").when(in_place, "already_in_destination").otherwise("success")
    )
    landed = F.concat(F.lit(target), file_name(source))
    return df.withColumns(
        {
            "status": status,
            "output_location": F.when(is_csv & in_place, source).when(is_csv, landed),
            "records_copied": F.when(is_csv & ~in_place, 1).otherwise(0),
        }
    )


def archive_candidates(
    df: DataFrame, feed: Feed, start: date, end: date, key: str = "object_key"
) -> DataFrame:
    """Files in the feed's landing folder whose name holds a day of the run, and where to
    move them.

    The day is the first run of eight digits in the file name.
    """
    name = file_name(F.col(key))
    digits = F.regexp_extract(name, r"(\d{8})", 1)
    day = F.try_to_timestamp(F.when(digits != "", digits), F.lit("yyyyMMdd")).cast("date")
    return (
        df.filter(F.col(key).startswith(LANDING[feed.name]))
        .filter(F.lower(F.col(key)).endswith(f".{feed.file_extension}"))
        .withColumn("processing_date", day)
        .filter(F.col("processing_date").between(F.lit(start), F.lit(end)))
        .withColumn(
            "archive_key",
            F.concat_ws(
                "/",
                F.lit("archive"),
                F.lit(feed.name),
                F.col("processing_date").cast("string"),
                name,
            ),
        )
    )
