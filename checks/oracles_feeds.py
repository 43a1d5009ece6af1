"""DuckDB SQL for the event feeds, files, jobs and status."""

from __future__ import annotations

from checks.oracles import (
    ALL_STEPS,
    DATED_STEPS,
    INVENTORY_RAW,
    POS_RAW,
    SALES,
    _INVENTORY_FIGURES,
    _METRICS,
)

NUMBERS = """numbers AS (SELECT event_id, ts,
  CASE event_id % 16 WHEN 0 THEN 3.7 WHEN 1 THEN null WHEN 2 THEN null WHEN 3 THEN 'nan'::double
    WHEN 4 THEN 1e12 WHEN 5 THEN '-inf'::double WHEN 6 THEN null WHEN 7 THEN null
    WHEN 8 THEN -2.9 WHEN 9 THEN 4 WHEN 10 THEN null ELSE value END::double AS d,
  event_id % 9 AS form FROM events)"""

_EPOCH = "make_timestamp(cast(round((floor(epoch(ts)) + 0.0465686::double) * 1e6) AS bigint))"

WEBLOGS = """weblogs AS (SELECT event_id,
  CASE WHEN event_id % 17 = 1 THEN null ELSE 's' || (event_id % 500) END AS session_id,
  CASE event_id % 13 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN '0' WHEN 4 THEN ''
    ELSE CASE WHEN user_id = 0 THEN '' ELSE cast(user_id AS varchar) END END AS user_id,
  '/' || event_type || '/' || user_id AS page,
  CASE WHEN event_id % 3 = 1 THEN 'mobile' END AS device_type,
  'b' || (event_id % 4) AS browser,
  CASE WHEN event_id % 19 = 5 THEN null ELSE event_type END AS event_type,
  CASE event_id % 11 WHEN 0 THEN null WHEN 1 THEN null
    WHEN 2 THEN make_timestamp(cast(floor(epoch(ts)) AS bigint) * 1000000)
    ELSE make_timestamp(cast(floor(epoch(ts)) AS bigint) * 1000000 + 250000) END
    AS event_timestamp FROM events)"""
INVALID = "(user_id = '' OR session_id IS NULL OR event_type IS NULL)"

CRM = """crm AS (SELECT conv_id, turn,
  CASE conv_id % 7 WHEN 0 THEN 3 WHEN 1 THEN null WHEN 2 THEN null WHEN 3 THEN null
    WHEN 4 THEN null WHEN 5 THEN CASE WHEN turn % 2 = 0 THEN 1 END
    ELSE cast(conv_id AS int) END AS customer_id,
  role AS interaction_type, CASE WHEN turn % 3 = 0 THEN 'chat' ELSE '' END AS channel,
  CASE (conv_id + turn) % 11 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 5 WHEN 3 THEN 5
    WHEN 8 THEN 2 WHEN 9 THEN 1 WHEN 10 THEN 1 ELSE 3 END::int AS rating,
  CASE turn % 3 WHEN 0 THEN '2025-07-17 20:41:00' WHEN 1 THEN '2025-07-17T20:41:00.25' END
    AS ingested,
  text AS message_excerpt,
  make_timestamp((1700000000 + conv_id * 60 + turn) * 1000000 + 500000) AS first_time,
  CASE turn % 4 WHEN 0 THEN timestamp '2025-07-17 20:40:36.066373'
    WHEN 1 THEN make_timestamp(cast(round((1700000000 + conv_id + 0.0465686::double) * 1e6)
      AS bigint)) END AS second_time FROM conversations)"""

_CRM_FIELDS = "customer_id, interaction_type, channel, rating, message_excerpt"

KEYS = """keys AS (SELECT event_id,
  CASE event_id % 6 WHEN 0 THEN 'pos' WHEN 2 THEN 'pos' WHEN 3 THEN 'raw/batch/inventory-raw'
    WHEN 5 THEN 'raw/batch/pos-raw' ELSE 'inventory' END AS folder,
  strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y%m%d') AS digits,
  CASE event_id % 5 WHEN 0 THEN '%20north+a' WHEN 1 THEN '+b' WHEN 2 THEN '%zz%20c%'
    ELSE '' END AS escaped,
  CASE event_id % 5 WHEN 0 THEN ' north a' WHEN 1 THEN ' b' WHEN 2 THEN '%zz c%'
    ELSE '' END AS plain,
  CASE event_id % 7 WHEN 0 THEN '.CSV' WHEN 1 THEN '.json' WHEN 2 THEN '.csv.gz'
    WHEN 3 THEN '.json' ELSE '.csv' END AS ext FROM events),
named AS (SELECT *, day || '_batch' || plain || '_' || event_id
    || CASE event_id % 3 WHEN 0 THEN '' ELSE '_' || digits END || ext AS plain_name,
  day || '_batch' || escaped || '_' || event_id
    || CASE event_id % 3 WHEN 0 THEN '' ELSE '_' || digits END || ext AS name FROM keys),
described AS (SELECT event_id, folder || '/' || name AS object_key,
  split_part(folder, '/', 1) AS data_type,
  CASE event_id % 7 WHEN 0 THEN 'CSV' WHEN 1 THEN 'json' WHEN 2 THEN 'gz' WHEN 3 THEN 'json'
    ELSE 'csv' END AS file_extension,
  CASE WHEN event_id % 6 IN (3, 5) THEN 'batch' ELSE day END AS processing_date FROM named)"""

# The first eight digits in a name: the event id itself could supply them beyond 8 digits.
_ARCHIVE = """SELECT event_id, folder || '/' || name AS object_key,
  cast(day AS date) AS processing_date, 'archive/{feed}/' || day || '/' || name AS archive_key,
  '{feed}' AS feed FROM named WHERE event_id % 3 <> 0 AND folder = 'raw/batch/{feed}-raw' AND {ext}"""

FILES = """numbered AS (SELECT *, event_id // 500 AS file_no FROM events)"""

ROWS_IN = """SELECT processing_date, count(*) AS {p}_rows_in,
  count(*) FILTER (error_reason IS NULL) AS {p}_valid,
  count(*) FILTER (error_reason IS NOT NULL) AS {p}_invalid FROM {t}_checked GROUP BY 1"""

_STATUS = """state AS (SELECT cast(ts AS date) AS processing_date,
  CASE event_type WHEN 'purchase' THEN 'pos' WHEN 'click' THEN 'pos' WHEN 'signup' THEN 'kpi'
    ELSE 'inv' END AS step,
  CASE WHEN event_id % 3 = 0 THEN 'FAILED' ELSE 'COMPLETED' END AS status, ts,
  'run-' || event_id AS run FROM events),
current AS (SELECT processing_date,
  arg_max(status, row(ts, run)) FILTER (step = 'pos') AS pos_transform_status,
  max(ts) FILTER (step = 'pos') AS pos_transform_timestamp,
  arg_max(run, row(ts, run)) FILTER (step = 'pos') AS execution_name_pos,
  arg_max(status, row(ts, run)) FILTER (step = 'inv') AS inventory_transform_status,
  max(ts) FILTER (step = 'inv') AS inventory_transform_timestamp,
  arg_max(run, row(ts, run)) FILTER (step = 'inv') AS execution_name_inventory,
  count(*) FILTER (step = 'kpi') > 0 AS kpi_job_triggered,
  max(ts) FILTER (step = 'kpi') AS kpi_trigger_timestamp FROM state GROUP BY 1)"""

FEED_ORACLES: dict[str, str] = {
    "safe_int": f"""WITH {NUMBERS} SELECT event_id,
  CASE WHEN isfinite(d) AND abs(d) < 2147483648 THEN cast(trunc(d) AS int) END AS number
FROM numbers""",
    "safe_rating": f"""WITH {NUMBERS} SELECT event_id, CASE WHEN d IS NULL OR NOT isfinite(d)
  THEN 3 ELSE cast(trunc(greatest(1, least(5, d))) AS int) END AS rating FROM numbers""",
    "epoch_to_iso": f"""WITH {NUMBERS} SELECT event_id,
  CASE WHEN form > 4 THEN {_EPOCH} END AS event_timestamp FROM numbers""",
    "iso_or_epoch": f"""WITH {NUMBERS} SELECT event_id,
  CASE WHEN form = 0 THEN ts WHEN form > 4 THEN {_EPOCH} END AS event_timestamp FROM numbers""",
    "copy_coercions": f"""WITH {NUMBERS} SELECT event_id,
  left(repeat(event_type || '-' || user_id || '/', event_id % 40), 255) AS page,
  CASE WHEN form = 0 THEN ts WHEN form = 1 THEN date_trunc('second', ts)
    WHEN form > 4 THEN {_EPOCH} END AS event_timestamp
FROM numbers JOIN (SELECT event_id, event_type, user_id FROM events) USING (event_id)""",
    "clean_crm": f"""WITH {CRM} SELECT conv_id, turn, {_CRM_FIELDS},
  first_time AS event_timestamp FROM crm""",
    "sanitize_crm": f"""WITH {CRM} SELECT conv_id, turn, {_CRM_FIELDS},
  second_time AS event_timestamp, ingested AS ingestion_timestamp FROM crm""",
    "clean_weblog": f"WITH {WEBLOGS} SELECT * FROM weblogs",
    "route_invalid": f"WITH {WEBLOGS} SELECT * FROM weblogs WHERE {INVALID}",
    "sample_rows": f"WITH {WEBLOGS} SELECT * FROM weblogs ORDER BY event_id LIMIT 10",
    "decode_envelope": """SELECT conv_id || '-' || turn AS "recordId",
  CASE WHEN (conv_id * 3 + turn) % 11 < 5 THEN 'ProcessingFailed' ELSE 'Ok' END AS result,
  CASE WHEN (conv_id * 3 + turn) % 11 >= 5 THEN role END AS role FROM conversations""",
    "transform_records": f"""WITH {CRM} SELECT conv_id || '-' || turn AS "recordId",
  CASE WHEN ok THEN 'Ok' ELSE 'ProcessingFailed' END AS verdict, NOT ok AS unchanged,
  CASE WHEN ok THEN customer_id END AS customer_id, CASE WHEN ok THEN rating END AS rating,
  CASE WHEN ok THEN channel END AS channel, CASE WHEN ok THEN message_excerpt END
    AS message_excerpt, CASE WHEN ok THEN second_time END AS event_timestamp,
  CASE WHEN ok THEN ingested END AS ingestion_timestamp
FROM (SELECT *, (conv_id * 3 + turn) % 11 >= 5 AS ok FROM crm)""",
    "first_record": f"""WITH {WEBLOGS} SELECT event_id,
  CASE WHEN event_id % 4 < 3 THEN page END AS page,
  CASE WHEN event_id % 4 < 3 THEN event_type END AS event_type FROM weblogs""",
    "jsonpath_weblogs": """SELECT event_id, event_type, 'b' || (event_id % 4) AS browser,
  null::varchar AS device_type, left(repeat('/' || event_type, event_id % 60), 255) AS page,
  cast(user_id AS varchar) AS user_id, 's' || (event_id % 500) AS session_id,
  ts AS ingestion_timestamp,
  make_timestamp(cast(floor(epoch(ts)) AS bigint) * 1000000 + 500000) AS event_timestamp
FROM events""",
    "load_web_logs": """SELECT event_type, 'b' || (event_id % 4) AS browser,
  null::varchar AS device_type, left(repeat('/' || event_type, event_id % 60), 255) AS page,
  cast(user_id AS varchar) AS user_id, 's' || (event_id % 500) AS session_id,
  ts AS ingestion_timestamp,
  make_timestamp(cast(floor(epoch(ts)) AS bigint) * 1000000 + 500000) AS event_timestamp
FROM events""",
    "jsonpath_weblogs_nested": """SELECT event_id, event_type, 'b' || (event_id % 4) AS browser,
  null::varchar AS device_type, left(repeat('/' || event_type, event_id % 60), 255) AS page,
  cast(user_id AS varchar) AS user_id, 's' || (event_id % 500) AS session_id,
  date_trunc('second', ts) AS ingestion_timestamp, ts AS event_timestamp FROM events""",
    "jsonpath_crm": """SELECT conv_id, turn,
  CASE (conv_id + turn) % 11 WHEN 0 THEN 0 WHEN 1 THEN 4 WHEN 2 THEN 9 WHEN 8 THEN 2 END::int
    AS rating,
  CASE conv_id % 7 WHEN 0 THEN 3 WHEN 6 THEN conv_id END::int AS customer_id,
  left(text, 255) AS message_excerpt, CASE WHEN turn % 3 = 0 THEN 'chat' END AS channel,
  role AS interaction_type, CASE turn % 3 WHEN 0 THEN timestamp '2025-07-17 20:41:00'
    WHEN 1 THEN timestamp '2025-07-17 20:41:00.25' END AS ingestion_timestamp,
  CASE turn % 4 WHEN 0 THEN timestamp '2025-07-17 20:40:36.066373'
    WHEN 1 THEN make_timestamp(cast(round((1700000000 + conv_id + 0.0465686::double) * 1e6)
      AS bigint)) WHEN 2 THEN timestamp '2025-07-17 20:40:36' END AS event_timestamp
FROM conversations""",
    "path_metadata": f"WITH {KEYS} SELECT * FROM described",
    "route_by_type": f"""WITH {KEYS} SELECT route, file_extension, count(*) AS count FROM (
  SELECT *, CASE WHEN data_type = 'pos' AND file_extension = 'csv' THEN 'pos'
    WHEN data_type = 'inventory' AND file_extension = 'json' THEN 'inventory'
    ELSE 'invalid_input' END AS route FROM described) GROUP BY 1, 2""",
    "land_csv": f"""WITH {KEYS} SELECT event_id, folder || '/' || name AS object_key,
  CASE WHEN lower(ext) <> '.csv' THEN 'skipped'
    WHEN folder = 'raw/batch/pos-raw' THEN 'already_in_destination' ELSE 'success' END
    AS status,
  CASE WHEN lower(ext) = '.csv' THEN 'raw/batch/pos-raw/' || plain_name END
    AS output_location,
  CASE WHEN lower(ext) = '.csv' AND folder <> 'raw/batch/pos-raw' THEN 1 ELSE 0 END
    AS records_copied FROM named""",
    "archive_candidates": f"""WITH {KEYS} {_ARCHIVE.format(feed='pos', ext="lower(ext) = '.csv'")}
UNION ALL {_ARCHIVE.format(feed='inventory', ext="ext = '.json'")}""",
    "scan_pos_raw": f"""SELECT transaction_id, cast(store_id AS varchar) AS store_id,
  cast(product_id AS varchar) AS product_id, cast(quantity AS varchar) AS quantity,
  cast(revenue AS varchar) AS revenue, cast(discount_applied AS varchar) AS discount_applied,
  cast("timestamp" AS varchar) AS "timestamp", partition_date AS processing_date
FROM ({POS_RAW})""",
    "scan_inventory_raw": f"""SELECT cast(inventory_id AS varchar) AS inventory_id,
  cast(product_id AS varchar) AS product_id, cast(warehouse_id AS varchar) AS warehouse_id,
  cast(stock_level AS varchar) AS stock_level,
  cast(restock_threshold AS varchar) AS restock_threshold,
  round(last_updated, 3) AS last_updated FROM ({INVENTORY_RAW})""",
    "normalize_json_files": f"""WITH {FILES} SELECT event_id, event_type,
  '[a], {{b}}' || CASE WHEN event_id % 3 = 0 THEN ' "q" \\' ELSE '' END AS note,
  cast(json_extract_string(props, '$.k') AS int) AS k
FROM numbered WHERE file_no % 6 <> 5""",
    "normalize_json_status": f"""WITH {FILES},
files AS (SELECT file_no, count(*) AS n FROM numbered GROUP BY 1)
SELECT CASE WHEN file_no % 6 = 5 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN file_no % 6 = 5 THEN 'unable to parse as JSON or JSON Lines' END AS reason,
  count(*) AS files, cast(sum(CASE WHEN file_no % 6 = 5 THEN 0 ELSE n END) AS bigint) AS records
FROM files GROUP BY 1, 2""",
    "manifest_scan": f"WITH {WEBLOGS} SELECT * EXCLUDE (event_id) FROM weblogs",
    "stream_weblogs": f"""WITH {WEBLOGS} SELECT * EXCLUDE (event_id) FROM weblogs
WHERE NOT coalesce({INVALID}, true)""",
    "stream_weblogs_invalid": f"""WITH {WEBLOGS}
SELECT session_id, user_id, event_type, page FROM weblogs WHERE {INVALID}""",
    "stream_crm": f"""WITH {CRM} SELECT {_CRM_FIELDS}, first_time AS event_timestamp FROM crm""",
    "archive_raw_payload": """SELECT role AS interaction_type, count(*) AS count
FROM conversations GROUP BY 1""",
    "time_partitioned_delivery": f"""WITH {WEBLOGS} SELECT
  strftime(event_timestamp, '%Y') AS year, strftime(event_timestamp, '%m') AS month,
  strftime(event_timestamp, '%d') AS day, strftime(event_timestamp, '%H') AS hour,
  count(*) AS count FROM weblogs WHERE NOT coalesce({INVALID}, true) GROUP BY 1, 2, 3, 4""",
    "repeated_delivery": f"""WITH {WEBLOGS},
moved AS (SELECT event_timestamp + INTERVAL 1 HOUR AS t FROM weblogs
  WHERE NOT coalesce({INVALID}, true))
SELECT strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS day,
  strftime(t, '%H') AS hour, count(*) AS count FROM moved GROUP BY 1, 2, 3, 4""",
    "incremental_scan": """SELECT 'web-logs' AS feed, count(*) AS count FROM events
UNION ALL SELECT 'crm', count(*) FROM conversations""",
    "stream_bucket_agg": f"""WITH {ALL_STEPS} SELECT product_id, analysis_date, time_bucket,
  total_quantity, cast(total_revenue AS decimal(18,4)) AS total_revenue,
  cast(total_discount AS decimal(18,4)) AS total_discount, transaction_count,
  array_to_string(store_list, ',') AS store_list, pos_timestamp FROM pos_cells""",
    "backfill_dates": """SELECT cast(d.range AS date) AS processing_date,
  count(e.event_id) AS rows
FROM (SELECT unnest(range(min(ts)::date, max(ts)::date + INTERVAL 1 day, INTERVAL 1 day)) AS range
  FROM events) d LEFT JOIN events e ON e.ts::date = d.range::date GROUP BY 1""",
    "backfill_status": f"""WITH {DATED_STEPS},
days AS (SELECT cast(unnest(range(min(ts)::date, max(ts)::date + INTERVAL 2 day,
  INTERVAL 1 day)) AS date) AS processing_date FROM events),
metrics AS (SELECT * EXCLUDE (inv_cells) FROM ({_METRICS})),
outcome AS (SELECT processing_date,
  {', '.join(f'coalesce({c}, 0) AS {c}' for c in (
      'pos_rows_in', 'pos_valid', 'pos_invalid', 'pos_kept', 'inventory_rows_in',
      'inventory_valid', 'inventory_invalid', 'inventory_kept', 'inventory_records_read',
      'pos_records_read', 'joined_records', 'join_success_rate', 'cell_match_rate'))}
  FROM days LEFT JOIN ({ROWS_IN.format(p='pos', t='pos')}) USING (processing_date)
  LEFT JOIN (SELECT processing_date, count(*) AS pos_kept FROM pos_silver GROUP BY 1)
    USING (processing_date)
  LEFT JOIN ({ROWS_IN.format(p='inventory', t='inv')}) USING (processing_date)
  LEFT JOIN (SELECT processing_date, count(*) AS inventory_kept FROM inv_silver GROUP BY 1)
    USING (processing_date)
  LEFT JOIN metrics USING (processing_date))
SELECT *, CASE WHEN joined_records > 0 THEN 'SUCCESS' ELSE 'PARTIAL_FAILURE' END AS status
FROM outcome""",
    "silver_roundtrip": f"WITH {DATED_STEPS} SELECT * FROM pos_silver",
    "daily_runs": f"WITH {DATED_STEPS} SELECT * FROM pos_silver",
    "logged_readiness": """SELECT d AS first_day, d + (n // 2)::INT AS last_day FROM (
  SELECT min(cast(ts AS date)) AS d, max(cast(ts AS date)) + 1 - min(cast(ts AS date)) AS n
  FROM events)""",
    "inventory_roundtrip": f"WITH {DATED_STEPS} SELECT * FROM inv_silver",
    "quarantine": f"""WITH {DATED_STEPS} SELECT *,
  processing_date AS processing_date_of_error, 'pos' AS source_type
FROM pos_checked, (VALUES ('first'), ('second')) runs(job_run_id)
WHERE error_reason IS NOT NULL""",
    "write_kpi_sales": f"WITH {DATED_STEPS} {SALES}",
    "write_kpi_inventory": f"""WITH {DATED_STEPS}
{_INVENTORY_FIGURES.format(cost='cost_price', source='joined')}""",
    "write_kpi_regional": f"""WITH {DATED_STEPS} SELECT processing_date, analysis_date, store_id,
  cast(sum(total_revenue) AS decimal(18,4)) AS store_daily_revenue,
  cast(sum(total_quantity) AS bigint) AS store_daily_quantity_sold,
  cast(sum(transaction_count) AS bigint) AS store_daily_transactions
FROM (SELECT *, unnest(store_list) AS store_id FROM joined) GROUP BY 1, 2, 3""",
    "replace_by_date": f"""WITH raw AS ({POS_RAW}),
bounds AS (SELECT min(ts)::date AS lo, max(ts)::date AS hi FROM events)
SELECT * EXCLUDE (partition_date, quantity, lo, hi), partition_date AS processing_date,
  CASE WHEN partition_date > lo + (hi - lo)::int // 2 THEN quantity * 2 ELSE quantity END
    AS quantity
FROM raw, bounds WHERE partition_date < hi""",
    "status_upsert": f"WITH {_STATUS} SELECT * FROM current",
    "kpi_readiness": f"""WITH {_STATUS} SELECT processing_date, NOT kpi_job_triggered AS still
FROM current WHERE pos_transform_status = 'COMPLETED'
  AND inventory_transform_status = 'COMPLETED'""",
    "claimed_days": f"""WITH {_STATUS} SELECT processing_date, 1::BIGINT AS runs
FROM current WHERE pos_transform_status = 'COMPLETED'
  AND inventory_transform_status = 'COMPLETED'""",
    "days_to_compute": """SELECT DISTINCT ts::date AS processing_date FROM events e
WHERE event_type = 'purchase'
  AND EXISTS (SELECT 1 FROM events s WHERE s.event_type = 'signup' AND s.ts::date = e.ts::date)
  AND epoch(ts::date) / 86400 >= (SELECT median(epoch(ts::date) / 86400) FROM events)""",
}

# The same answers by another way.
FEED_ORACLES["stream_transform_records"] = FEED_ORACLES["transform_records"]
FEED_ORACLES["delivered_load"] = FEED_ORACLES["stream_weblogs"]
