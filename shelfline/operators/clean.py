"""Cleaning of customer interactions and web logs, from a variant ``payload`` column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.casts import (
    as_number,
    epoch_text_to_timestamp,
    iso_or_epoch,
    safe_int,
    safe_rating,
)
from shelfline.functions.columns import once
from shelfline.functions.payload import OK, compact_json, decode_envelope, field

# The columns delivered, and those a web log needs.
CRM_COLUMNS = [
    "customer_id",
    "interaction_type",
    "channel",
    "rating",
    "message_excerpt",
    "event_timestamp",
    "ingestion_timestamp",
]
WEBLOG_COLUMNS = [
    "session_id",
    "user_id",
    "page",
    "device_type",
    "browser",
    "event_type",
    "event_timestamp",
    "ingestion_timestamp",
]
REQUIRED_IN_WEBLOG = ["user_id", "session_id", "event_type"]


def _fields(
    df: DataFrame, names: Sequence[str], keep: Sequence[str], numbers: Sequence[str] = ()
) -> DataFrame:
    """The payload's fields as text, each read once however often it is used.

    JSON's true and false are 1 and 0 in ``numbers``; the texts "true" and "false" are not.
    """

    def read(name: str) -> Column:
        text = field(F.col("payload"), f"$.{name}")
        if name in numbers:
            json = F.to_json(field(F.col("payload"), f"$.{name}", "variant"))
            text = F.when(json == "true", "1").when(json == "false", "0").otherwise(text)
        return text.alias(name)

    return df.select(*keep, *map(read, names))


def text_default(text: Column) -> Column:
    """Missing and JSON null give ''."""
    return F.coalesce(text, F.lit(""))


def falsy_to_empty(text: Column, json: Column) -> Column:
    """'' for a missing, null, false, empty or zero field, else its text.

    The JSON form tells the number 0 from the text "0", which stays.
    """
    empty = json.isin("null", "false", '""', "[]", "{}") | (as_number(json) == 0)
    return F.when(json.isNull() | F.coalesce(empty, F.lit(False)), "").otherwise(text)


_CRM_NUMBERS = ["customer_id", "rating"]
_CRM_TEXT = ["customer_id", "interaction_type", "channel", "rating", "message_excerpt"]


def _crm(event_timestamp: Column, ingested: Column) -> list[Column]:
    return [
        safe_int(F.col("customer_id")).alias("customer_id"),
        text_default(F.col("interaction_type")).alias("interaction_type"),
        text_default(F.col("channel")).alias("channel"),
        safe_rating(F.col("rating")).alias("rating"),
        text_default(F.col("message_excerpt")).alias("message_excerpt"),
        event_timestamp.alias("event_timestamp"),
        ingested.alias("ingestion_timestamp"),
    ]


def clean_crm(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """First cleaning of a customer interaction; event time comes as epoch ``timestamp``."""
    event_time = epoch_text_to_timestamp(F.col("timestamp"))
    return _fields(df, [*_CRM_TEXT, "timestamp"], keep, _CRM_NUMBERS).select(
        *keep, *_crm(event_time, F.current_timestamp())
    )


def sanitize_crm(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Second cleaning, on delivery: ``event_timestamp`` is ISO text or epoch seconds;
    ``ingestion_timestamp`` is passed on as it is."""
    times = ["event_timestamp", "ingestion_timestamp"]
    return _fields(df, [*_CRM_TEXT, *times], keep, _CRM_NUMBERS).select(
        *keep,
        *_crm(iso_or_epoch(F.col("event_timestamp")), F.col("ingestion_timestamp")),
        F.current_timestamp().alias("processed_at"),
    )


def transform_records(envelopes: DataFrame) -> DataFrame:
    """Delivery hook: (recordId, data) to (recordId, result, data).

    Data of a good record is its sanitized form, that of a failed one is left as it came.
    """
    decoded = sanitize_crm(decode_envelope(envelopes), keep=["recordId", "result", "data"])
    sanitized = F.base64(F.encode(compact_json(*CRM_COLUMNS, "processed_at"), "utf-8"))
    return decoded.select(
        "recordId",
        "result",
        F.when(F.col("result") == OK, sanitized).otherwise(F.col("data")).alias("data"),
    )


def clean_weblog(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    user = F.to_json(field(F.col("payload"), "$.user_id", "variant"))
    plain = ["page", "device_type", "browser", "event_type"]
    fields = _fields(
        df.withColumn("_user", user), ["session_id", "user_id", *plain, "timestamp"], [*keep, "_user"]
    )
    return fields.select(
        *keep,
        "session_id",
        falsy_to_empty(F.col("user_id"), F.col("_user")).alias("user_id"),
        *plain,
        epoch_text_to_timestamp(F.col("timestamp")).alias("event_timestamp"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def _flagged(cleaned: DataFrame) -> DataFrame:
    """Mark rows with a required field that is NULL or, after cleaning, ''."""
    blank = [F.col(c).isNull() | (F.col(c) == "") for c in REQUIRED_IN_WEBLOG]
    return once(cleaned, "_invalid", reduce(or_, blank))


def valid_weblogs(cleaned: DataFrame) -> DataFrame:
    return _flagged(cleaned).filter(~F.col("_invalid")).drop("_invalid")


def invalid_weblogs(cleaned: DataFrame) -> DataFrame:
    return _flagged(cleaned).filter("_invalid").drop("_invalid")
