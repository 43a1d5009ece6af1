"""The same answers in DuckDB SQL, written from the rules rather than from the Spark code."""

from __future__ import annotations

POS_RAW = """
SELECT 'T' || cast(event_id - event_id % 2 AS varchar) AS transaction_id,
  cast(event_id % 8 AS int) AS store_id, cast(user_id % 20 AS int) AS product_id,
  cast(cast(floor(value) AS bigint) % 12 - 1 AS int) AS quantity,
  cast(value AS float) AS revenue,
  CASE WHEN event_id % 4 = 0 THEN null ELSE cast(value * 0.1::double AS float) END
    AS discount_applied,
  cast(floor(epoch(ts)) AS bigint) AS "timestamp", cast(ts AS date) AS partition_date
FROM events WHERE event_type IN ('purchase', 'click')"""

INVENTORY_RAW = """
SELECT cast(event_id - event_id % 2 AS int) AS inventory_id,
  cast(user_id % 20 AS int) AS product_id, cast(event_id % 5 AS int) AS warehouse_id,
  cast(cast(floor(value) AS bigint) % 40 - 1 AS int) AS stock_level,
  CASE WHEN event_id % 3 = 0 THEN null ELSE cast(event_id % 15 - 1 AS int) END
    AS restock_threshold,
  epoch_us(ts) / 1000000.0::double AS last_updated, cast(ts AS date) AS partition_date
FROM events WHERE event_type NOT IN ('purchase', 'click')"""

POS_REASON = """
CASE WHEN "timestamp" IS NULL OR "timestamp" <= 0 THEN 'Rule violation for timestamp'
  WHEN revenue < 0 THEN 'Rule violation for revenue'
  WHEN quantity < 0 THEN 'Rule violation for quantity'
  WHEN revenue IS NULL THEN 'Null in required field: revenue'
  WHEN quantity IS NULL THEN 'Null in required field: quantity'
  WHEN product_id IS NULL THEN 'Null in required field: product_id'
  WHEN store_id IS NULL THEN 'Null in required field: store_id'
  WHEN transaction_id IS NULL THEN 'Null in required field: transaction_id' END"""

INVENTORY_REASON = """
CASE WHEN last_updated IS NULL OR last_updated <= 0 THEN 'Rule violation for last_updated'
  WHEN restock_threshold < 0 THEN 'Rule violation for restock_threshold'
  WHEN stock_level < 0 THEN 'Rule violation for stock_level'
  WHEN stock_level IS NULL THEN 'Null in required field: stock_level'
  WHEN warehouse_id IS NULL THEN 'Null in required field: warehouse_id'
  WHEN product_id IS NULL THEN 'Null in required field: product_id'
  WHEN inventory_id IS NULL THEN 'Null in required field: inventory_id' END"""


def _pos_steps(run_date: str, keys: str) -> str:
    """CTEs pos_raw .. pos_silver. ``run_date`` is SQL for the processing date."""
    return f"""
pos_raw AS ({POS_RAW}),
pos_checked AS (SELECT * EXCLUDE (partition_date), {run_date} AS processing_date,
  {POS_REASON} AS error_reason FROM pos_raw),
pos_valid AS (SELECT * EXCLUDE (error_reason) FROM pos_checked WHERE error_reason IS NULL),
pos_enriched AS (SELECT *,
  cast(to_timestamp("timestamp") AT TIME ZONE 'UTC' AS timestamp) AS transaction_timestamp,
  CASE WHEN revenue >= 100 THEN 'HIGH_VALUE' WHEN revenue >= 50 THEN 'MEDIUM_VALUE'
    ELSE 'LOW_VALUE' END AS sale_category FROM pos_valid),
pos_silver AS (SELECT * FROM pos_enriched QUALIFY row_number() OVER (
  PARTITION BY {keys} transaction_id ORDER BY transaction_timestamp DESC NULLS LAST,
  store_id DESC NULLS LAST, product_id DESC NULLS LAST, quantity DESC NULLS LAST,
  revenue DESC NULLS LAST, discount_applied DESC NULLS LAST) = 1)"""


def _inventory_steps(run_date: str, keys: str) -> str:
    return f"""
inv_raw AS ({INVENTORY_RAW}),
inv_checked AS (SELECT * EXCLUDE (partition_date), {run_date} AS processing_date,
  {INVENTORY_REASON} AS error_reason FROM inv_raw),
inv_valid AS (SELECT * EXCLUDE (error_reason) FROM inv_checked WHERE error_reason IS NULL),
inv_enriched AS (SELECT inventory_id, product_id, warehouse_id, stock_level,
  restock_threshold, make_timestamp(cast(trunc(last_updated) AS bigint) * 1000000)
    AS last_updated,
  CASE WHEN stock_level = 0 THEN 'OUT_OF_STOCK' WHEN stock_level < 10 THEN 'LOW_STOCK'
    ELSE 'IN_STOCK' END AS stock_status, processing_date FROM inv_valid),
inv_silver AS (SELECT * FROM inv_enriched QUALIFY row_number() OVER (
  PARTITION BY {keys} inventory_id ORDER BY last_updated DESC NULLS LAST,
  product_id DESC NULLS LAST, warehouse_id DESC NULLS LAST, stock_level DESC NULLS LAST,
  restock_threshold DESC NULLS LAST, stock_status DESC NULLS LAST) = 1)"""


CELL_STEPS = """
inv_cells AS (SELECT processing_date, product_id, cast(last_updated AS date) AS analysis_date,
    hour(last_updated) // 2 * 2 AS time_bucket,
    arg_max(stock_level, row(last_updated, inventory_id)) AS stock_level,
    arg_max(stock_status, row(last_updated, inventory_id)) AS stock_status,
    arg_max(warehouse_id, row(last_updated, inventory_id)) AS warehouse_id,
    max(last_updated) AS inv_timestamp, count(*) AS inventory_rows
  FROM inv_silver GROUP BY 1, 2, 3, 4),
pos_cells AS (SELECT processing_date, product_id,
    cast(transaction_timestamp AS date) AS analysis_date,
    hour(transaction_timestamp) // 2 * 2 AS time_bucket,
    cast(sum(quantity) AS bigint) AS total_quantity,
    sum(cast(revenue AS double)) AS total_revenue,
    sum(cast(discount_applied AS double)) AS total_discount,
    count(transaction_id) AS transaction_count,
    list_sort(list(DISTINCT store_id)) AS store_list,
    max(transaction_timestamp) AS pos_timestamp
  FROM pos_silver GROUP BY 1, 2, 3, 4),
joined AS (SELECT i.processing_date, i.product_id, i.analysis_date, i.time_bucket,
    stock_level, stock_status, warehouse_id, 10.0::double AS cost_price,
    'General' AS category, total_quantity, total_revenue, total_discount,
    transaction_count, store_list, inv_timestamp, pos_timestamp
  FROM inv_cells i JOIN pos_cells p USING (processing_date, product_id, analysis_date,
    time_bucket))"""

_DAY = "date '2024-01-31'"
POS_STEPS = _pos_steps(_DAY, "")
INVENTORY_STEPS = _inventory_steps(_DAY, "")
ALL_STEPS = f"{POS_STEPS},{INVENTORY_STEPS},{CELL_STEPS}"

# Per-date runs: each event day is its own processing date and is de-duplicated alone.
DATED_STEPS = (
    f"{_pos_steps('partition_date', 'processing_date,')},"
    f"{_inventory_steps('partition_date', 'processing_date,')},{CELL_STEPS}"
)

_SUMMARY = """SELECT count(*) AS total_rows,
  count(*) FILTER (error_reason IS NULL) AS valid_rows,
  count(*) FILTER (error_reason IS NOT NULL) AS invalid_rows,
  count(*) FILTER (error_reason IS NULL)::double / count(*) * 100 AS validation_rate,
  CASE WHEN count(*) FILTER (error_reason IS NOT NULL) = 0 THEN 'success'
    ELSE 'partial_success' END AS status"""

POS_TEXT_CHECKED = f"""
text_rows AS (SELECT
  CASE event_id % 29 WHEN 3 THEN null ELSE 'T' || event_id END AS transaction_id,
  CASE event_id % 31 WHEN 4 THEN null ELSE cast(event_id % 8 AS int) END AS store_id,
  CASE event_id % 37 WHEN 5 THEN null ELSE cast(user_id % 20 AS int) END AS product_id,
  CASE event_id % 23 WHEN 0 THEN null WHEN 1 THEN cast(event_id % 9 AS int) WHEN 2 THEN -1
    WHEN 3 THEN null WHEN 4 THEN null WHEN 5 THEN 0 WHEN 6 THEN 0
    ELSE cast(event_id % 9 AS int) END AS quantity,
  CASE event_id % 19 WHEN 6 THEN 'nan'::float WHEN 7 THEN null WHEN 8 THEN -1::float
    ELSE cast(value AS float) END AS revenue,
  CASE event_id % 17 WHEN 9 THEN null ELSE cast(event_id % 5 AS float) END
    AS discount_applied,
  CASE event_id % 13 WHEN 10 THEN null WHEN 11 THEN 0
    ELSE cast(floor(epoch(ts)) AS bigint) END AS "timestamp" FROM events),
text_checked AS (SELECT *, {POS_REASON} AS error_reason FROM text_rows)"""

SALES = """SELECT processing_date, analysis_date,
  cast(sum(total_revenue) AS decimal(18,4)) AS total_daily_revenue,
  cast(sum(total_quantity) AS bigint) AS total_daily_quantity_sold,
  cast(sum(total_discount) AS decimal(18,4)) AS total_daily_discount_given,
  count(DISTINCT product_id) AS distinct_products_sold_daily,
  cast(avg(total_revenue / nullif(total_quantity, 0)) AS decimal(18,4))
    AS average_price_per_item
FROM joined GROUP BY 1, 2"""

_INVENTORY_FIGURES = """SELECT processing_date, analysis_date, warehouse_id,
  cast(sum(stock_level) AS bigint) AS total_stock_level,
  count(DISTINCT product_id) AS distinct_products_in_stock,
  count(*) FILTER (stock_status = 'IN_STOCK') AS products_in_stock,
  count(*) FILTER (stock_status = 'OUT_OF_STOCK') AS products_out_of_stock,
  cast(sum(stock_level * {cost}) AS decimal(18,4)) AS total_stock_value
FROM {source} GROUP BY 1, 2, 3"""

_METRICS = """SELECT *, coalesce(joined_records::double / nullif(inventory_records_read, 0) * 100, 0)
    AS join_success_rate,
  coalesce(joined_records::double / nullif(inv_cells, 0) * 100, 0) AS cell_match_rate
FROM (SELECT processing_date,
    (SELECT count(*) FROM inv_silver s WHERE s.processing_date = d.processing_date)
      AS inventory_records_read,
    (SELECT count(*) FROM pos_silver s WHERE s.processing_date = d.processing_date)
      AS pos_records_read,
    (SELECT count(*) FROM joined s WHERE s.processing_date = d.processing_date)
      AS joined_records,
    (SELECT count(*) FROM inv_cells s WHERE s.processing_date = d.processing_date) AS inv_cells
  FROM (SELECT processing_date FROM inv_cells UNION SELECT processing_date FROM pos_cells) d)"""

BATCH_ORACLES: dict[str, str] = {
    "pos_valid": f"WITH {POS_STEPS} SELECT * FROM pos_valid",
    "pos_invalid": f"WITH {POS_STEPS} SELECT * FROM pos_checked WHERE error_reason IS NOT NULL",
    "inventory_valid": f"WITH {INVENTORY_STEPS} SELECT * FROM inv_valid",
    "inventory_invalid": f"""WITH {INVENTORY_STEPS}
SELECT * FROM inv_checked WHERE error_reason IS NOT NULL""",
    "pos_text_valid": f"""WITH {POS_TEXT_CHECKED}
SELECT * EXCLUDE (error_reason) FROM text_checked WHERE error_reason IS NULL""",
    "pos_text_invalid": f"""WITH {POS_TEXT_CHECKED}
SELECT * FROM text_checked WHERE error_reason IS NOT NULL""",
    "pos_missing_column": f"""SELECT * EXCLUDE (store_id, quantity),
  'Missing critical required fields in input DataFrame: [''store_id'', ''quantity'']'
    AS error_reason FROM ({POS_RAW})""",
    "inventory_missing_nullable": f"""SELECT * EXCLUDE (restock_threshold, partition_date),
  null::int AS restock_threshold FROM ({INVENTORY_RAW}) WHERE stock_level >= 0""",
    "pos_validation_summary": f"WITH {POS_STEPS} {_SUMMARY} FROM pos_checked",
    "inventory_validation_summary": f"WITH {INVENTORY_STEPS} {_SUMMARY} FROM inv_checked",
    "pos_enriched": f"WITH {POS_STEPS} SELECT * FROM pos_enriched",
    "inventory_enriched": f"WITH {INVENTORY_STEPS} SELECT * FROM inv_enriched",
    "pos_dedup": f"WITH {POS_STEPS} SELECT * FROM pos_silver",
    "inventory_dedup": f"WITH {INVENTORY_STEPS} SELECT * FROM inv_silver",
    "stream_inventory_dedup": f"WITH {INVENTORY_STEPS} SELECT * FROM inv_silver",
    "dedup_report": f"""WITH {POS_STEPS},{INVENTORY_STEPS}
SELECT 'pos' AS source_type, count(*) AS rows_before,
  count(DISTINCT transaction_id) AS rows_after,
  count(*) - count(DISTINCT transaction_id) AS duplicates_removed FROM pos_enriched
UNION ALL SELECT 'inventory', count(*), count(DISTINCT inventory_id),
  count(*) - count(DISTINCT inventory_id) FROM inv_enriched""",
    "lineitem_dedup": """SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
  l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST,
  l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
  l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1""",
    "inventory_bucket_agg": f"WITH {ALL_STEPS} SELECT * FROM inv_cells",
    "pos_bucket_agg": f"""WITH {ALL_STEPS} SELECT * REPLACE (
  cast(total_revenue AS decimal(18,4)) AS total_revenue,
  cast(total_discount AS decimal(18,4)) AS total_discount,
  array_to_string(store_list, ',') AS store_list) FROM pos_cells""",
    "bucket_join": f"""WITH {ALL_STEPS} SELECT * REPLACE (
  cast(total_revenue AS decimal(18,4)) AS total_revenue,
  cast(total_discount AS decimal(18,4)) AS total_discount,
  array_to_string(store_list, ',') AS store_list) FROM joined""",
    "failed_joins": f"""WITH {ALL_STEPS} SELECT processing_date, product_id, analysis_date,
  time_bucket, stock_level, warehouse_id,
  'No matching POS data for product, date, and time bucket' AS error_reason
FROM inv_cells ANTI JOIN pos_cells USING (processing_date, product_id, analysis_date,
  time_bucket)""",
    "sales_kpis": f"WITH {ALL_STEPS} {SALES}",
    "inventory_kpis": f"""WITH {ALL_STEPS}
{_INVENTORY_FIGURES.format(cost='cost_price', source='joined')}""",
    "inventory_kpis_priced": f"""WITH {ALL_STEPS},
priced AS (SELECT j.* EXCLUDE (cost_price),
  coalesce(p.p_retailprice, 10.0::double) AS cost_price
  FROM joined j LEFT JOIN part p ON p.p_partkey = j.product_id)
{_INVENTORY_FIGURES.format(cost='cost_price', source='priced')}""",
    "regional_kpis": f"""WITH {ALL_STEPS} SELECT processing_date, analysis_date, store_id,
  cast(sum(total_revenue) AS decimal(18,4)) AS store_daily_revenue,
  cast(sum(total_quantity) AS bigint) AS store_daily_quantity_sold,
  cast(sum(transaction_count) AS bigint) AS store_daily_transactions
FROM (SELECT *, unnest(store_list) AS store_id FROM joined) GROUP BY 1, 2, 3""",
    "regional_kpis_exact": f"""WITH {ALL_STEPS} SELECT processing_date,
  cast(transaction_timestamp AS date) AS analysis_date, store_id,
  cast(sum(cast(revenue AS double)) AS decimal(18,4)) AS store_daily_revenue,
  cast(sum(quantity) AS bigint) AS store_daily_quantity_sold,
  count(*) AS store_daily_transactions
FROM pos_silver p WHERE EXISTS (SELECT 1 FROM inv_cells i
  WHERE i.processing_date = p.processing_date AND i.product_id = p.product_id
    AND i.analysis_date = cast(p.transaction_timestamp AS date)
    AND i.time_bucket = hour(p.transaction_timestamp) // 2 * 2)
GROUP BY 1, 2, 3""",
    "processing_metrics": f"WITH {ALL_STEPS} SELECT * EXCLUDE (inv_cells) FROM ({_METRICS})",
}
