"""Archived raw responses of the two interfaces, one response per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import once
from shelfline.functions.payload import first_record, with_strict_json


def with_payload(df: DataFrame, text: str = "value") -> DataFrame:
    """Add ``payload``: the strict JSON value, or NULL for text that is not one."""
    return with_strict_json(df, text, "payload")


def with_first_record(df: DataFrame, text: str = "value") -> DataFrame:
    """As above, with a list payload reduced to its first record."""
    whole = with_strict_json(df, text, "_whole")
    return once(whole, "payload", first_record(F.col("_whole"), F.col(text))).drop("_whole")
