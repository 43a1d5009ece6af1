"""Cleaning of the event feeds, as batch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import casts
from shelfline.functions.payload import (
    CRM_FLAT,
    WEBLOG_FLAT,
    WEBLOG_NESTED,
    decode_envelope,
    field,
    jsonpath_project,
)
from shelfline.operators import clean
from shelfline.queries.registry import query, query_named
from shelfline.sources import tables
from shelfline.sources.responses import with_first_record, with_payload


def _number(spark, sf, name, fn, column="number"):
    return tables.number_text(spark, sf).select("event_id", fn(F.col(column)).alias(name))


@query
def safe_int(spark, sf):
    return _number(spark, sf, "number", casts.safe_int)


@query
def safe_rating(spark, sf):
    return _number(spark, sf, "rating", casts.safe_rating)


@query
def epoch_to_iso(spark, sf):
    return _number(spark, sf, "event_timestamp", casts.epoch_text_to_timestamp, "time")


@query
def iso_or_epoch(spark, sf):
    return _number(spark, sf, "event_timestamp", casts.iso_or_epoch, "time")


@query
def copy_coercions(spark, sf):
    """Loader coercions: text clipped to its column, time in any format."""
    return tables.number_text(spark, sf).select(
        "event_id",
        casts.clip(F.col("text"), 255).alias("page"),
        casts.any_timestamp(F.col("time")).alias("event_timestamp"),
    )


@query
def clean_crm(spark, sf):
    parsed = with_payload(tables.crm_json(spark, sf))
    return clean.clean_crm(parsed, keep=["conv_id", "turn"]).drop("ingestion_timestamp")


@query
def sanitize_crm(spark, sf):
    parsed = with_payload(tables.crm_json(spark, sf))
    return clean.sanitize_crm(parsed, keep=["conv_id", "turn"]).drop("processed_at")


@query
def clean_weblog(spark, sf):
    parsed = with_payload(tables.weblog_json(spark, sf))
    return clean.clean_weblog(parsed, keep=["event_id"]).drop("ingestion_timestamp")


@query
def route_invalid(spark, sf):
    return clean.invalid_weblogs(clean_weblog(spark, sf))


@query_named("decode_envelope")
def decoded_envelopes(spark, sf):
    """Verdict per enveloped record, with a field of those that decode."""
    return decode_envelope(tables.envelopes(spark, sf)).select(
        "recordId", "result", field(F.col("payload"), "$.interaction_type").alias("role")
    )


@query
def transform_records(spark, sf):
    """The delivery hook: good records decoded again, failed ones held against their input."""
    came = tables.envelopes(spark, sf)
    return held_against(clean.transform_records(came), came)


def held_against(hooked, came):
    """What the hook made of the envelopes that came, with its good records decoded again."""
    sent = decode_envelope(hooked.withColumnRenamed("result", "verdict"))
    payload, good = F.col("payload"), F.col("verdict") == "Ok"

    def sent_field(name: str, kind: str = "string"):
        return F.when(good, field(payload, f"$.{name}", kind)).alias(name)

    time = casts.iso_or_epoch(field(payload, "$.event_timestamp"))
    # Texts built from a table are far larger than the table on disk, by which Spark would
    # take them for small enough to be sent through the driver.
    inputs = came.select("recordId", F.col("data").alias("input")).hint("merge")
    return sent.join(inputs, "recordId").select(
        "recordId",
        "verdict",
        F.col("data").eqNullSafe(F.col("input")).alias("unchanged"),
        sent_field("customer_id", "int"),
        sent_field("rating", "int"),
        sent_field("channel"),
        sent_field("message_excerpt"),
        F.when(good, time).alias("event_timestamp"),
        sent_field("ingestion_timestamp"),
    )


@query
def first_record(spark, sf):
    parsed = with_first_record(tables.responses(spark, sf))
    payload = F.col("payload")
    return parsed.select(
        "event_id",
        field(payload, "$.page").alias("page"),
        field(payload, "$.event_type").alias("event_type"),
    )


@query
def jsonpath_weblogs(spark, sf):
    parsed = with_payload(tables.weblog_delivered(spark, sf), "flat")
    return jsonpath_project(parsed, WEBLOG_FLAT, keep=["event_id"])


@query
def jsonpath_weblogs_nested(spark, sf):
    parsed = with_payload(tables.weblog_delivered(spark, sf), "nested")
    return jsonpath_project(parsed, WEBLOG_NESTED, keep=["event_id"])


@query
def jsonpath_crm(spark, sf):
    parsed = with_payload(tables.crm_json(spark, sf))
    return jsonpath_project(parsed, CRM_FLAT, keep=["conv_id", "turn"])


@query
def sample_rows(spark, sf):
    """The ten first rows by id of the cleaned web logs; the limit is the feature."""
    return clean_weblog(spark, sf).orderBy("event_id").limit(10)
