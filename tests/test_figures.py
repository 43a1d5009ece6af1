from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline.operators import cells, dedup, kpis, status

DAY = date(2025, 7, 20)
POS_SCHEMA = """transaction_id string, store_id int, product_id int, quantity int,
    revenue float, discount_applied float, transaction_timestamp timestamp,
    processing_date date"""
INV_SCHEMA = """inventory_id int, product_id int, warehouse_id int, stock_level int,
    restock_threshold int, last_updated timestamp, stock_status string, processing_date date"""


def at(hour, minute=0, second=0):
    return datetime(2025, 7, 20, hour, minute, second)


def pos_frame(spark, *rows):
    return spark.createDataFrame(
        [(f"T{i}", s, p, q, r, d, t, DAY) for i, (s, p, q, r, d, t) in enumerate(rows)],
        POS_SCHEMA,
    )


def inv_frame(spark, *rows):
    return spark.createDataFrame(
        [(i, p, w, s, None, t, st, DAY) for i, (p, w, s, t, st) in enumerate(rows)], INV_SCHEMA
    )


def match(inv, pos):
    return cells.match_cells(cells.inventory_cells(inv), cells.pos_cells(pos))


def test_latest_copy_wins_and_ties_are_settled(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 5, "p"), ("b", 5, "q"), ("c", None, "n")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    for parts in (1, 4):
        got = dedup.latest_per_key(df.repartition(parts), ["k"], "t").collect()
        assert sorted((r.k, r.t, r.v) for r in got) == [
            ("a", 2, "y"), ("b", 5, "q"), ("c", None, "n")
        ]
    once = dedup.latest_per_key(df, ["k"], "t")
    twice = dedup.latest_per_key(once, ["k"], "t")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_duplicates_are_cut_before_the_shuffle(spark):
    """A third of all rows under one key: one row per map task crosses the shuffle."""
    df = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'hot', string(id)) AS k", "id AS t", "id * 2 AS v"
    )
    kept = dedup.latest_per_key(df, ["k"], "t")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before
    assert kept.count() == 20_001
    assert kept.filter("k = 'hot'").first().t == 29_997


def test_dedup_report(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    got = dedup.dedup_report(df, "k").first()
    assert (got.rows_before, got.rows_after, got.duplicates_removed) == (3, 2, 1)
    assert dedup.dedup_report(df.limit(0), "k").first().rows_before == 0


def test_buckets_bound_the_match(spark):
    inv = inv_frame(spark, (1, 1, 5, at(12), "LOW_STOCK"), (2, 1, 50, at(13, 59, 59), "IN_STOCK"))
    pos = pos_frame(
        spark,
        (1, 1, 1, 10.0, None, at(13, 59, 59)),
        (1, 2, 1, 10.0, None, at(14)),
        (1, 3, 1, 10.0, None, at(14)),
    )
    both = match(inv, pos)
    joined, failed = cells.matched(both).collect(), cells.failed(both).collect()
    assert [(r.product_id, r.time_bucket) for r in joined] == [(1, 12)]
    assert [(r.product_id, r.time_bucket) for r in failed] == [(2, 12)]
    assert failed[0].error_reason == "No matching POS data for product, date, and time bucket"
    assert len(joined) + len(failed) == cells.inventory_cells(inv).count()


def test_joined_fact_layout(spark):
    inv = inv_frame(spark, (1, 1, 5, at(12), "LOW_STOCK"))
    pos = pos_frame(spark, (2, 1, 1, 10.0, 1.0, at(12)), (1, 1, 1, 5.0, None, at(13)))
    row = cells.matched(match(inv, pos)).drop("store_sales").first().asDict()
    assert row == {
        "processing_date": DAY, "product_id": 1, "analysis_date": DAY, "time_bucket": 12,
        "stock_level": 5, "stock_status": "LOW_STOCK", "warehouse_id": 1, "cost_price": 10.0,
        "category": "General", "total_quantity": 2, "total_revenue": 15.0,
        "total_discount": 1.0, "transaction_count": 2, "store_list": [1, 2],
        "inv_timestamp": at(12), "pos_timestamp": at(13),
    }


def test_latest_reading_hides_other_warehouses(spark):
    inv = inv_frame(
        spark, (1, 7, 50, at(12), "IN_STOCK"), (1, 8, 0, at(13), "OUT_OF_STOCK")
    )
    got = cells.inventory_cells(inv).first()
    assert (got.stock_level, got.stock_status, got.warehouse_id) == (0, "OUT_OF_STOCK", 8)
    assert got.inventory_rows == 2 and got.inv_timestamp == at(13)


def test_sales_figures(spark):
    inv = inv_frame(spark, *[(p, 1, 5, at(12), "LOW_STOCK") for p in (1, 2, 3)])
    pos = pos_frame(
        spark,
        (1, 1, 2, 10.0, None, at(12)),
        (1, 2, 1, 20.0, None, at(12)),
        (1, 3, 0, 7.0, None, at(12)),
    )
    got = kpis.sales_kpis(cells.matched(match(inv, pos))).first()
    assert got.total_daily_revenue == Decimal("37.0000")
    assert got.total_daily_discount_given is None
    assert got.distinct_products_sold_daily == 3
    # The mean of 5 and 20; the cell without items is skipped.
    assert got.average_price_per_item == Decimal("12.5000")


def test_average_price_is_null_without_items(spark):
    inv = inv_frame(spark, (1, 1, 5, at(12), "LOW_STOCK"))
    pos = pos_frame(spark, (1, 1, 0, 7.0, None, at(12)))
    assert kpis.sales_kpis(cells.matched(match(inv, pos))).first().average_price_per_item is None


def test_revenue_that_is_no_number_does_not_fail_the_job(spark):
    inv = inv_frame(spark, (1, 1, 5, at(12), "LOW_STOCK"))
    pos = pos_frame(spark, (1, 1, 1, float("nan"), float("inf"), at(12)), (1, 1, 1, 2.0, 1.0, at(12)))
    joined = cells.matched(match(inv, pos))
    got = kpis.sales_kpis(joined).first()
    assert got.total_daily_revenue is None and got.average_price_per_item is None
    assert got.total_daily_discount_given is None and got.total_daily_quantity_sold == 2
    assert kpis.regional_kpis_exact(joined).first().store_daily_revenue is None


def test_inventory_figures_add_over_buckets(spark):
    inv = inv_frame(
        spark,
        (1, 1, 10, at(8), "IN_STOCK"),
        (1, 1, 5, at(10), "LOW_STOCK"),
        (1, 1, 0, at(12), "OUT_OF_STOCK"),
    )
    pos = pos_frame(spark, *[(1, 1, 1, 1.0, None, at(h)) for h in (8, 10, 12)])
    got = kpis.inventory_kpis(cells.matched(match(inv, pos))).first()
    assert got.total_stock_level == 15 and got.distinct_products_in_stock == 1
    assert (got.products_in_stock, got.products_out_of_stock) == (1, 1)
    assert got.total_stock_value == Decimal("150.0000")


def test_product_dimension_replaces_the_placeholder(spark):
    inv = inv_frame(spark, (1, 1, 10, at(8), "IN_STOCK"), (2, 1, 10, at(8), "IN_STOCK"))
    pos = pos_frame(spark, *[(1, p, 1, 1.0, None, at(8)) for p in (1, 2)])
    products = spark.createDataFrame(
        [(1, 2.5, "Toys")], "product_id int, cost_price double, category string"
    )
    rows = {r.product_id: r for r in cells.matched(match(inv, pos), products).collect()}
    assert (rows[1].cost_price, rows[1].category) == (2.5, "Toys")
    assert (rows[2].cost_price, rows[2].category) == (10.0, "General")


def test_regional_forms(spark):
    inv = inv_frame(spark, (1, 1, 5, at(12), "LOW_STOCK"))
    pos = pos_frame(spark, (1, 1, 1, 10.0, None, at(12)), (2, 1, 3, 30.0, None, at(12)))
    joined = cells.matched(match(inv, pos))
    whole = {r.store_id: r for r in kpis.regional_kpis(joined).collect()}
    own = {r.store_id: r for r in kpis.regional_kpis_exact(joined).collect()}
    assert [whole[s].store_daily_revenue for s in (1, 2)] == [Decimal("40.0000")] * 2
    assert [own[s].store_daily_revenue for s in (1, 2)] == [Decimal("10.0000"), Decimal("30.0000")]
    assert [own[s].store_daily_transactions for s in (1, 2)] == [1, 1]
    sales = kpis.sales_kpis(joined).first()
    assert sum(r.store_daily_quantity_sold for r in own.values()) == sales.total_daily_quantity_sold
    assert sum(r.store_daily_revenue for r in own.values()) == sales.total_daily_revenue


def test_metrics(spark):
    inv = inv_frame(
        spark,
        (1, 1, 5, at(12), "LOW_STOCK"),
        (1, 1, 6, at(13), "LOW_STOCK"),
        (2, 1, 5, at(12), "LOW_STOCK"),
    )
    pos = pos_frame(
        spark, (1, 1, 1, 1.0, None, at(12)), (1, 9, 1, 1.0, None, at(12)),
        (2, 9, 1, 1.0, None, at(12)),
    )
    got = kpis.processing_metrics(match(inv, pos)).first()
    assert (got.inventory_records_read, got.pos_records_read, got.joined_records) == (3, 3, 1)
    assert got.join_success_rate == pytest.approx(100 / 3)
    assert got.cell_match_rate == 50.0


def test_status_log(spark):
    rows = [
        (DAY, "pos_transform", "FAILED", at(1), "e1"),
        (DAY, "pos_transform", "COMPLETED", at(2), "e2"),
        (DAY, "inventory_transform", "COMPLETED", at(1), "e3"),
        (date(2025, 7, 21), "pos_transform", "COMPLETED", at(1), "e4"),
        (date(2025, 7, 22), "pos_transform", "COMPLETED", at(1), "e5"),
        (date(2025, 7, 22), "inventory_transform", "COMPLETED", at(1), "e6"),
        (date(2025, 7, 22), "kpi_job", "COMPLETED", at(3), "e7"),
    ]
    events = spark.createDataFrame(
        rows, "processing_date date, step string, status string, at timestamp, execution_name string"
    )
    now = {r.processing_date: r for r in status.current_status(events).collect()}
    assert now[DAY].pos_transform_status == "COMPLETED" and now[DAY].execution_name_pos == "e2"
    assert now[date(2025, 7, 21)].inventory_transform_status is None
    assert now[date(2025, 7, 22)].kpi_trigger_timestamp == at(3)
    ready = status.ready_for_kpis(status.current_status(events)).collect()
    assert [r.processing_date for r in ready] == [DAY]


def test_hot_cell_needs_no_wide_group(spark):
    """A third of the sales in one cell: sums stay exact and stores are one entry each."""
    rows = spark.range(30_000).select(
        F.concat(F.lit("T"), F.col("id")).alias("transaction_id"),
        (F.col("id") % 5).cast("int").alias("store_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997 + 2).cast("int").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(0.5).cast("float").alias("revenue"),
        F.lit(None).cast("float").alias("discount_applied"),
        F.lit(at(12)).alias("transaction_timestamp"),
        F.lit(DAY).alias("processing_date"),
    )
    hot = cells.pos_cells(rows).filter("product_id = 1").first()
    assert hot.total_quantity == 10_000 and hot.total_revenue == 5_000.0
    assert hot.store_list == [0, 1, 2, 3, 4] and len(hot.store_sales) == 5


def test_match_adds_no_shuffle(spark):
    """One exchange for stock, two for sales, and none for the join of both."""
    inv = inv_frame(spark, (1, 1, 5, at(12), "LOW_STOCK"))
    pos = pos_frame(spark, (1, 1, 1, 10.0, None, at(12)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = match(inv, pos)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 3
