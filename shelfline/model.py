"""What each batch feed looks like: declared columns, row rules, keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import types as T

Rule = Callable[[Column], Column]


@dataclass(frozen=True)
class Feed:
    """A batch feed. Columns declared not nullable are the required ones."""

    name: str
    schema: T.StructType
    rules: Mapping[str, Rule]
    key: str
    order_by: str
    file_extension: str

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _non_negative(c: Column) -> Column:
    return c >= 0


def _null_or_non_negative(c: Column) -> Column:
    return c.isNull() | (c >= 0)


def _set_and_positive(c: Column) -> Column:
    return c.isNotNull() & (c > 0)


# Feed layouts, rules and keys.
POS = Feed(
    name="pos",
    schema=T.StructType()
    .add("transaction_id", T.StringType(), False)
    .add("store_id", T.IntegerType(), False)
    .add("product_id", T.IntegerType(), False)
    .add("quantity", T.IntegerType(), False)
    .add("revenue", T.FloatType(), False)
    .add("discount_applied", T.FloatType(), True)
    .add("timestamp", T.LongType(), False),
    rules={
        "quantity": _non_negative,
        "revenue": _non_negative,
        "timestamp": _set_and_positive,
    },
    key="transaction_id",
    order_by="timestamp",
    file_extension="csv",
)

INVENTORY = Feed(
    name="inventory",
    schema=T.StructType()
    .add("inventory_id", T.IntegerType(), False)
    .add("product_id", T.IntegerType(), False)
    .add("warehouse_id", T.IntegerType(), False)
    .add("stock_level", T.IntegerType(), False)
    .add("restock_threshold", T.IntegerType(), True)
    .add("last_updated", T.DoubleType(), False),
    rules={
        "stock_level": _non_negative,
        "restock_threshold": _null_or_non_negative,
        "last_updated": _set_and_positive,
    },
    key="inventory_id",
    order_by="last_updated",
    file_extension="json",
)

FEEDS = {f.name: f for f in (POS, INVENTORY)}

# Texts of the reasons kept with rejected rows and unmatched cells.
MISSING_COLUMNS = "Missing critical required fields in input DataFrame: {}"
NULL_FIELD = "Null in required field: {}"
BROKEN_RULE = "Rule violation for {}"
NO_DAY = "No processing date in folder or file name"
NO_POS_MATCH = "No matching POS data for product, date, and time bucket"

# Names of the figures' tables.
SALES_KPI = "sales_kpi_daily"
INVENTORY_KPI = "inventory_kpi_daily"
REGIONAL_KPI = "regional_kpi_daily"

# Placeholders used where no product dimension is given.
DEFAULT_COST_PRICE = 10.0
DEFAULT_CATEGORY = "General"

PROCESSING_DATE = "processing_date"
CELL = [PROCESSING_DATE, "product_id", "analysis_date", "time_bucket"]
