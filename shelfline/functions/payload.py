"""JSON payloads as variants: strict parsing, envelopes, path lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.casts import any_timestamp, clip, lenient_cast
from shelfline.functions.columns import once

OK = "Ok"
FAILED = "ProcessingFailed"


def with_strict_json(df: DataFrame, text: str, into: str = "payload") -> DataFrame:
    """Add the one JSON value that ``text`` is, as a variant; NULL if it is anything else.

    ``try_parse_json`` stops after the first value and ignores what follows. Wrapped in an
    array the first value must reach to the closing bracket, so text after it breaks the
    array or adds a second element. Only text holding a ``]`` could close the array early;
    that one is also tried inside an object, which no such text can close.
    """
    raw, in_array = F.col(text), F.col("_in_array")
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    alone = F.try_variant_get(in_array, "$[1]", "variant").isNull()
    closed = ~raw.contains("]") | in_object.isNotNull()
    value = F.when(alone & closed, F.try_variant_get(in_array, "$[0]", "variant"))
    parsed = once(df, "_in_array", F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))))
    return once(parsed, into, value).drop("_in_array")


def starts_object(text: Column) -> Column:
    return text.rlike(r"^\s*\{")


def starts_array(text: Column) -> Column:
    return text.rlike(r"^\s*\[")


def field(payload: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(payload, path, kind)


def first_record(payload: Column, text: Column) -> Column:
    """Element 0 of a list payload, any other payload as it is. An empty list stays a list."""
    head = F.try_variant_get(payload, "$[0]", "variant")
    return F.when(starts_array(text), F.coalesce(head, payload)).otherwise(payload)


def decoded_text(data: Column) -> Column:
    """Base64 to UTF-8 text; NULL when either decoding fails.

    Characters outside the alphabet are skipped, wrong padding fails.
    """
    symbols = F.regexp_replace(data, "[^A-Za-z0-9+/=]", "")
    raw = F.when(F.length(symbols) % 4 == 0, F.try_to_binary(symbols, F.lit("base64")))
    return F.try_validate_utf8(raw.cast("string"))


def decode_envelope(df: DataFrame) -> DataFrame:
    """Add ``payload`` (an object, or NULL) and ``result`` to (recordId, data) rows."""
    text = decoded_text(F.col("data"))
    opened = once(df, "_text", text)
    is_object = starts_object(F.col("_text"))
    parsed = with_strict_json(
        opened.withColumn("_text", F.when(is_object, F.col("_text"))), "_text"
    )
    return parsed.withColumn(
        "result", F.when(F.col("payload").isNull(), FAILED).otherwise(OK)
    ).drop("_text")


@dataclass(frozen=True)
class Target:
    """A column filled from a payload. ``width`` clips text as the loader does."""

    name: str
    path: str
    kind: str = "string"
    width: int | None = None


# Path lists of the two streams, in load order, and the columns' widths.
WEBLOG_COLUMNS = [
    "event_type",
    "browser",
    "device_type",
    "page",
    "user_id",
    "session_id",
]
WEBLOG_FLAT = [Target(c, f"$.{c}", width=255) for c in WEBLOG_COLUMNS] + [
    Target("ingestion_timestamp", "$.ingestion_timestamp", "timestamp"),
    Target("event_timestamp", "$.event_timestamp", "timestamp"),
]
WEBLOG_NESTED = [Target(c, f"$.payload.{c}", width=255) for c in WEBLOG_COLUMNS] + [
    Target("ingestion_timestamp", "$.timestamp", "timestamp"),
    Target("event_timestamp", "$.payload.timestamp", "timestamp"),
]
CRM_FLAT = [
    Target("rating", "$.rating", "int"),
    Target("customer_id", "$.customer_id", "int"),
    Target("message_excerpt", "$.message_excerpt", width=255),
    Target("channel", "$.channel", width=50),
    Target("interaction_type", "$.interaction_type", width=50),
    Target("ingestion_timestamp", "$.ingestion_timestamp", "timestamp"),
    Target("event_timestamp", "$.event_timestamp", "timestamp"),
]


def jsonpath_project(
    df: DataFrame, targets: Sequence[Target], payload: str = "payload", keep: Sequence[str] = ()
) -> DataFrame:
    """Payload to columns by a path list, with the loader's coercions.

    Text is clipped to its column's width; timestamps may be ISO text or epoch seconds.
    """
    def typed(t: Target) -> Column:
        text = F.col(t.name)
        if t.kind == "timestamp":
            value = any_timestamp(text)
        elif t.kind == "string":
            value = clip(text, t.width) if t.width else text
        else:
            value = lenient_cast(text, T.StringType(), T.DataType.fromDDL(t.kind))
        return value.alias(t.name)

    read = [field(F.col(payload), t.path).alias(t.name) for t in targets]
    return df.select(*keep, *read).select(*keep, *[typed(t) for t in targets])


def compact_json(*columns: str) -> Column:
    """One compact JSON object per row, nulls kept, timestamps ISO to the microsecond."""
    return F.to_json(
        F.struct(*columns),
        {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    )
