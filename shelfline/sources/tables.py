"""The given tables seen as the pipeline's feeds.

Every view is a projection of a whole table, but for the two raw feeds, which share the
events between them by their type. Case columns are spread over the rows by the
row's id, so each branch of a check or cleaner meets data whose amount grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_DATE = "2024-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pos_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases and clicks as till lines; two neighbouring ids share a transaction."""
    return (
        table(spark, sf_dir, "events")
        .filter("event_type IN ('purchase', 'click')")
        .selectExpr(
            "concat('T', event_id - event_id % 2) AS transaction_id",
            "int(event_id % 8) AS store_id",
            "int(user_id % 20) AS product_id",
            "int(bigint(floor(value)) % 12 - 1) AS quantity",
            "float(value) AS revenue",
            "if(event_id % 4 = 0, null, float(value * 0.1D)) AS discount_applied",
            "unix_seconds(timestamp(ts)) AS `timestamp`",
            "date(ts) AS partition_date",
        )
    )


def inventory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All other events as stock readings."""
    return (
        table(spark, sf_dir, "events")
        .filter("event_type NOT IN ('purchase', 'click')")
        .selectExpr(
            "int(event_id - event_id % 2) AS inventory_id",
            "int(user_id % 20) AS product_id",
            "int(event_id % 5) AS warehouse_id",
            "int(bigint(floor(value)) % 40 - 1) AS stock_level",
            "if(event_id % 3 = 0, null, int(event_id % 15 - 1)) AS restock_threshold",
            "unix_micros(timestamp(ts)) / 1000000D AS last_updated",
            "date(ts) AS partition_date",
        )
    )


def pos_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a till line of text, with bad and missing values among them."""
    return table(spark, sf_dir, "events").selectExpr(
        "CASE event_id % 29 WHEN 3 THEN null ELSE concat('T', event_id) END AS transaction_id",
        "CASE event_id % 31 WHEN 4 THEN '' ELSE string(event_id % 8) END AS store_id",
        "CASE event_id % 37 WHEN 5 THEN 'none' ELSE string(user_id % 20) END AS product_id",
        """CASE event_id % 23 WHEN 0 THEN 'abc' WHEN 1 THEN concat(event_id % 9, '.7')
             WHEN 2 THEN '-1' WHEN 3 THEN '99999999999' WHEN 4 THEN '1e3' WHEN 5 THEN '.5' WHEN 6 THEN '-.7'
             ELSE string(event_id % 9) END AS quantity""",
        """CASE event_id % 19 WHEN 6 THEN 'NaN' WHEN 7 THEN 'x' WHEN 8 THEN '-1'
             ELSE string(value) END AS revenue""",
        "CASE event_id % 17 WHEN 9 THEN '' ELSE string(event_id % 5) END AS discount_applied",
        """CASE event_id % 13 WHEN 10 THEN '' WHEN 11 THEN '0'
             ELSE string(unix_seconds(timestamp(ts))) END AS `timestamp`""",
    )


def product_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost and category per product, from the parts."""
    return table(spark, sf_dir, "part").selectExpr(
        "int(p_partkey) AS product_id", "p_retailprice AS cost_price", "p_type AS category"
    )


def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object key per event, over types, dates, extensions and escaped names."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """concat(
             CASE event_id % 6 WHEN 0 THEN 'pos' WHEN 1 THEN 'inventory' WHEN 2 THEN 'pos'
               WHEN 3 THEN 'raw/batch/inventory-raw' WHEN 4 THEN 'inventory'
               ELSE 'raw/batch/pos-raw' END,
             '/', date_format(ts, 'yyyy-MM-dd'), '_batch',
             CASE event_id % 5 WHEN 0 THEN '%20north+a' WHEN 1 THEN '+b'
               WHEN 2 THEN '%zz%20c%' ELSE '' END,
             '_', event_id,
             CASE event_id % 3 WHEN 0 THEN '' ELSE date_format(ts, '_yyyyMMdd') END,
             CASE event_id % 7 WHEN 0 THEN '.CSV' WHEN 1 THEN '.json' WHEN 2 THEN '.csv.gz'
               WHEN 3 THEN '.json' ELSE '.csv' END) AS object_key""",
    )


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion messages of the two transforms and of the figures' job, per day."""
    return table(spark, sf_dir, "events").selectExpr(
        "date(ts) AS processing_date",
        """CASE event_type WHEN 'purchase' THEN 'pos_transform' WHEN 'click' THEN 'pos_transform'
             WHEN 'signup' THEN 'kpi_job' ELSE 'inventory_transform' END AS step""",
        "if(event_id % 3 = 0, 'FAILED', 'COMPLETED') AS status",
        "timestamp(ts) AS at",
        "concat('run-', event_id) AS execution_name",
    )


def weblog_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One web log record of JSON text per event."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """concat('{"session_id":',
             CASE event_id % 17 WHEN 1 THEN 'null' ELSE concat('"s', event_id % 500, '"') END,
             ',"user_id":',
             CASE event_id % 13 WHEN 0 THEN 'null' WHEN 1 THEN '""' WHEN 2 THEN '0'
               WHEN 3 THEN '"0"' WHEN 4 THEN 'false' ELSE string(user_id) END,
             ',"page":"/', event_type, '/', user_id, '"',
             CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN ',"device_type":"mobile"'
               ELSE ',"device_type":null' END,
             ',"browser":"b', event_id % 4, '","event_type":',
             CASE event_id % 19 WHEN 5 THEN 'null' ELSE concat('"', event_type, '"') END,
             ',"timestamp":',
             CASE event_id % 11 WHEN 0 THEN '"soon"' WHEN 1 THEN 'null'
               WHEN 2 THEN concat('"', unix_seconds(timestamp(ts)), '"')
               ELSE concat(unix_seconds(timestamp(ts)), '.25') END,
             ',"props":', props, '}') AS value""",
    )


def crm_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer interaction of JSON text per conversation turn."""
    record = F.expr(
        """concat('{"customer_id":',
             CASE conv_id % 7 WHEN 0 THEN '"3.7"' WHEN 1 THEN '"x"' WHEN 2 THEN 'null'
               WHEN 3 THEN '"NaN"' WHEN 4 THEN '99999999999'
               WHEN 5 THEN if(turn % 2 = 0, 'true', '"true"') ELSE string(conv_id) END,
             ',"interaction_type":"', role, '"',
             CASE turn % 3 WHEN 0 THEN ',"channel":"chat"' WHEN 1 THEN ',"channel":null'
               ELSE '' END,
             CASE (conv_id + turn) % 11 WHEN 9 THEN ',"rating":true' WHEN 10 THEN ',"rating":false'
               WHEN 0 THEN ',"rating":0' WHEN 1 THEN ',"rating":4.9'
               WHEN 2 THEN ',"rating":9' WHEN 3 THEN ',"rating":1e12' WHEN 4 THEN ',"rating":"x"'
               WHEN 5 THEN ',"rating":null' WHEN 6 THEN ',"rating":"inf"' WHEN 7 THEN ''
               ELSE ',"rating":"2"' END,
             ',"timestamp":', 1700000000 + conv_id * 60 + turn, '.5',
             CASE turn % 4
               WHEN 0 THEN ',"event_timestamp":"2025-07-17T20:40:36.066373"'
               WHEN 1 THEN concat(',"event_timestamp":', 1700000000 + conv_id, '.0465686')
               WHEN 2 THEN ',"event_timestamp":"2025-07-17 20:40:36"'
               ELSE ',"event_timestamp":"noTime"' END,
             CASE turn % 3 WHEN 0 THEN ',"ingestion_timestamp":"2025-07-17 20:41:00"'
               WHEN 1 THEN ',"ingestion_timestamp":"2025-07-17T20:41:00.25"' ELSE '' END,
             ',"message_excerpt":', to_json(text), '}')"""
    )
    # to_json of a plain string needs a variant around it.
    return (
        table(spark, sf_dir, "conversations")
        .withColumn("text", F.expr("CAST(text AS VARIANT)"))
        .select("conv_id", "turn", record.alias("value"))
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer interactions wrapped for delivery, some of them damaged."""
    return crm_json(spark, sf_dir).selectExpr(
        "concat(conv_id, '-', turn) AS recordId",
        """CASE (conv_id * 3 + turn) % 11
             WHEN 0 THEN '@@@'
             WHEN 1 THEN base64(unhex('ff41'))
             WHEN 2 THEN base64(encode('{bad', 'utf-8'))
             WHEN 3 THEN base64(encode(concat(value, ' trailing'), 'utf-8'))
             WHEN 4 THEN base64(encode(concat('[', value, ']'), 'utf-8'))
             ELSE base64(encode(value, 'utf-8')) END AS data""",
    )


def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text per event that may or may not be a number or a time."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE event_id % 16 WHEN 0 THEN '3.7' WHEN 1 THEN 'x' WHEN 2 THEN null
             WHEN 3 THEN 'NaN' WHEN 4 THEN '1e12' WHEN 5 THEN '-inf' WHEN 6 THEN '' WHEN 7 THEN '3d'
             WHEN 8 THEN '-2.9' WHEN 9 THEN ' 4 ' WHEN 10 THEN '0x10' ELSE string(value) END AS number""",
        """CASE event_id % 9 WHEN 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
             WHEN 1 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') WHEN 2 THEN 'noTime'
             WHEN 3 THEN null WHEN 4 THEN 'inf'
             ELSE concat(unix_seconds(timestamp(ts)), '.0465686') END AS time""",
        "repeat(concat(event_type, '-', user_id, '/'), int(event_id % 40)) AS text",
    )


def weblog_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered web log records, flat and nested under ``payload``."""
    iso = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    fields = """'"event_type":"', event_type, '","browser":"b', event_id % 4,
        '","page":"', repeat(concat('/', event_type), int(event_id % 60)),
        '","user_id":', user_id, ',"session_id":"s', event_id % 500, '"'"""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"""concat('{{', {fields}, ',"ingestion_timestamp":"', {iso}, '","event_timestamp":',
              unix_seconds(timestamp(ts)), '.5}}') AS flat""",
        f"""concat('{{"timestamp":', unix_seconds(timestamp(ts)), ',"payload":{{', {fields},
              ',"timestamp":"', {iso}, '"}}}}') AS nested""",
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interface responses: a list, a list of one, a single record, or an empty list."""
    return weblog_json(spark, sf_dir).selectExpr(
        "event_id",
        """CASE event_id % 4 WHEN 0 THEN concat('[', value, ',{"page":"other"}]')
             WHEN 1 THEN concat(' [', value, ']') WHEN 2 THEN value ELSE '[]' END AS value""",
    )


RECORDS_PER_FILE = 500


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of one JSON file per 500 events, in six shapes; the last has a broken line."""
    events = table(spark, sf_dir, "events").selectExpr(
        f"event_id div {RECORDS_PER_FILE} AS file_no",
        "event_id",
        """concat('{"event_id":', event_id, ',"event_type":"', event_type, '","note":"[a], {b}',
             if(event_id % 3 = 0, ' \\\\"q\\\\" \\\\\\\\', ''), '","props":', props, '}') AS record""",
    )
    files = events.groupBy("file_no").agg(
        F.expr("transform(array_sort(collect_list(struct(event_id, record))), r -> r.record)").alias(
            "records"
        )
    )
    return files.selectExpr(
        "file_no",
        """CASE file_no % 6
             WHEN 4 THEN concat('[\n', array_join(records, '\n, '), '\n]')
             WHEN 0 THEN array_join(records, '\n')
             WHEN 1 THEN concat('[', array_join(records, ', '), ']')
             WHEN 2 THEN concat('[\n', array_join(records, ',\n'), '\n]')
             WHEN 3 THEN concat('[\n  ', replace(array_join(records, ',\n  '), ',"', ',\n    "'),
               '\n]')
             ELSE concat(array_join(records, '\n\n'), '\n{"broken": ') END AS text""",
    )
