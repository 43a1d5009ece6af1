import math

import pytest

from shelfline.model import INVENTORY, POS
from shelfline.operators import enrich, validate

COLUMNS = ["transaction_id", "store_id", "product_id", "quantity", "revenue",
           "discount_applied", "timestamp"]
GOOD = {"transaction_id": "T1", "store_id": "1", "product_id": "2", "quantity": "3",
        "revenue": "60", "discount_applied": "1.5", "timestamp": "1752784836"}
INVENTORY_GOOD = {"inventory_id": 1, "product_id": 2, "warehouse_id": 3, "stock_level": 9,
                  "restock_threshold": 5, "last_updated": 1752784836.9}


def pos_frame(spark, *changes):
    rows = [{**GOOD, **c} for c in changes]
    schema = ", ".join(f"`{c}` string" for c in COLUMNS)
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], schema)


def pos_check(spark, **change):
    return validate.check(pos_frame(spark, change), POS).first()


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"quantity": "abc"}, "Null in required field: quantity"),
        ({"quantity": "-1"}, "Rule violation for quantity"),
        ({"quantity": "0"}, None),
        ({"quantity": "99999999999"}, "Null in required field: quantity"),
        ({"quantity": "1e3"}, "Null in required field: quantity"),
        ({"timestamp": ""}, "Rule violation for timestamp"),
        ({"timestamp": None}, "Rule violation for timestamp"),
        ({"timestamp": "0"}, "Rule violation for timestamp"),
        ({"quantity": "-1", "revenue": "-1"}, "Rule violation for revenue"),
        ({"store_id": "", "product_id": ""}, "Null in required field: product_id"),
        ({"store_id": "", "quantity": "-1"}, "Rule violation for quantity"),
        ({"transaction_id": None}, "Null in required field: transaction_id"),
        ({"revenue": "NaN"}, None),
        ({"revenue": "x"}, "Null in required field: revenue"),
        ({"discount_applied": "x"}, None),
    ],
)
def test_pos_reason(spark, change, reason):
    assert pos_check(spark, **change).error_reason == reason


@pytest.mark.parametrize(
    "text, value",
    [("3.7", 3), (" 4 ", 4), ("-2.9", -2), ("+5", 5), ("7.", 7), ("2147483648", None),
     ("2147483647.9", 2147483647), ("", None), ("1 2", None), (".", None)],
)
def test_text_to_whole_number(spark, text, value):
    assert pos_check(spark, quantity=text).quantity == value


@pytest.mark.parametrize("text", ["inf", "-Infinity", "NaN", ".5", "5.", "1e-3", "+1", "1E5"])
def test_text_to_fraction(spark, text):
    got = pos_check(spark, discount_applied=text).discount_applied
    want = float(text)
    assert (math.isnan(got) and math.isnan(want)) or got == pytest.approx(want)


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"restock_threshold": None}, None),
        ({"restock_threshold": -1}, "Rule violation for restock_threshold"),
        ({"last_updated": None}, "Rule violation for last_updated"),
        ({"stock_level": -1, "restock_threshold": -1}, "Rule violation for restock_threshold"),
        ({"stock_level": None}, "Null in required field: stock_level"),
        ({"inventory_id": None, "warehouse_id": None}, "Null in required field: warehouse_id"),
    ],
)
def test_inventory_reason(spark, change, reason):
    schema = """inventory_id int, product_id int, warehouse_id int, stock_level int,
        restock_threshold int, last_updated double"""
    row = {**INVENTORY_GOOD, **change}
    df = spark.createDataFrame([tuple(row.values())], schema)
    assert validate.check(df, INVENTORY).first().error_reason == reason


def test_absent_nullable_column_is_null_in_both_feeds(spark):
    got = validate.check(pos_frame(spark, {}).drop("discount_applied"), POS)
    assert got.schema["discount_applied"].dataType.simpleString() == "float"
    assert got.first().discount_applied is None and got.first().error_reason is None
    rows = spark.createDataFrame([tuple(INVENTORY_GOOD.values())], list(INVENTORY_GOOD))
    got = validate.check(rows.drop("restock_threshold"), INVENTORY).first()
    assert got.restock_threshold is None and got.error_reason is None


def test_absent_required_column_rejects_the_frame(spark):
    df = pos_frame(spark, {}, {}).drop("store_id")
    checked = validate.check(df, POS)
    assert validate.valid_rows(checked).count() == 0
    reasons = {r.error_reason for r in validate.invalid_rows(checked).collect()}
    assert reasons == {
        "Missing critical required fields in input DataFrame: ['store_id']"
    }


def test_split_is_total_and_summary_counts(spark):
    df = pos_frame(spark, {}, {"quantity": "-1"}, {"store_id": None}, {"timestamp": "x"})
    checked = validate.check(df, POS)
    good, bad = validate.valid_rows(checked).count(), validate.invalid_rows(checked).count()
    assert (good, bad) == (1, 3)
    got = validate.summary(checked).first()
    assert (got.total_rows, got.valid_rows, got.invalid_rows) == (4, 1, 3)
    assert got.validation_rate == 25.0 and got.status == "partial_success"
    empty = validate.summary(checked.limit(0)).first()
    assert (empty.total_rows, empty.validation_rate, empty.status) == (0, 0.0, "success")


def test_categories(spark):
    rows = pos_frame(
        spark, *[{"revenue": r} for r in ("49.99", "50", "99.99", "100", "NaN")]
    )
    valid = validate.valid_rows(validate.check(rows, POS))
    got = [r.sale_category for r in enrich.enrich_pos(valid).collect()]
    assert got == ["LOW_VALUE", "MEDIUM_VALUE", "MEDIUM_VALUE", "HIGH_VALUE", "HIGH_VALUE"]


def test_inventory_layout(spark):
    rows = [(1, 2, 3, s, None, 1752784836.9) for s in (0, 9, 10)]
    df = spark.createDataFrame(
        rows, """inventory_id int, product_id int, warehouse_id int, stock_level int,
        restock_threshold int, last_updated double"""
    )
    valid = validate.valid_rows(validate.check(enrich.stamp_date(df, "2025-07-20"), INVENTORY))
    got = enrich.audit(enrich.enrich_inventory(valid), "run", "redshift_load_timestamp")
    assert got.columns == [
        "inventory_id", "product_id", "warehouse_id", "stock_level", "restock_threshold",
        "last_updated", "stock_status", "processing_date", "job_run_id",
        "redshift_load_timestamp",
    ]
    assert [r.stock_status for r in got.collect()] == ["OUT_OF_STOCK", "LOW_STOCK", "IN_STOCK"]
    text = got.selectExpr("string(last_updated) AS t").first().t
    assert text == "2025-07-17 20:40:36"


def test_epoch_beyond_a_timestamp_does_not_fail_the_job(spark):
    rows = pos_frame(spark, {"timestamp": "9000000000000000000"})
    got = enrich.enrich_pos(validate.valid_rows(validate.check(rows, POS))).first()
    assert got.transaction_timestamp is None


def test_reason_is_computed_once(spark):
    """The reject filter must not drag copies of the casts below them."""
    checked = validate.invalid_rows(validate.check(pos_frame(spark, {}), POS))
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS quantity") == 1 and "Filter isnotnull(error_reason" in plan
