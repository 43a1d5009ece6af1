"""Decisions about files, and reading files that Spark wrote from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.config import new_shared_path
from shelfline.functions.payload import field
from shelfline.model import INVENTORY, POS, PROCESSING_DATE
from shelfline.operators import clean, objects
from shelfline.plans.load import TABLES, load_stream
from shelfline.queries.feeds import held_against
from shelfline.queries.registry import query, query_named
from shelfline.sources import raw, tables
from shelfline.sources.json_files import normalize_json_files, write_json_lines
from shelfline.sources.manifest import manifest_scan, plain_path, write_manifest
from shelfline.sources.responses import with_payload
from shelfline.streaming.cells import LateRows, latest_cells, run_cells
from shelfline.streaming.feeds import (
    HOOKED,
    delivery_parts,
    incremental_scan,
    manifest_path,
    run_feed,
    run_hook,
)


@query
def path_metadata(spark, sf):
    return objects.path_metadata(tables.object_keys(spark, sf))


@query
def route_by_type(spark, sf):
    described = objects.path_metadata(tables.object_keys(spark, sf))
    return objects.route_by_type(described).groupBy("route", "file_extension").count()


@query
def land_csv(spark, sf):
    return objects.land_csv(tables.object_keys(spark, sf))


def _archive(spark, sf, feed):
    keys = tables.object_keys(spark, sf)
    first, last = _days(spark, sf)
    return objects.archive_candidates(keys, feed, first, last)


def _days(spark, sf):
    """First and last event day; reads the time column only."""
    events = tables.table(spark, sf, "events")
    return events.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()


@query
def archive_candidates(spark, sf):
    pos = _archive(spark, sf, POS).withColumn("feed", F.lit(POS.name))
    inventory = _archive(spark, sf, INVENTORY).withColumn("feed", F.lit(INVENTORY.name))
    return pos.unionByName(inventory)


@query_named("scan_pos_raw")
def pos_csv_scan(spark, sf):
    """Till lines written as CSV by day and read back with the day pruning folders."""
    path = new_shared_path(spark, "pos-csv")
    rows = tables.pos_raw(spark, sf)
    rows.write.partitionBy("partition_date").option("header", True).csv(path)
    return raw.for_days(raw.scan_pos_raw(spark, path), *_days(spark, sf)).drop(raw.UNDATED)


@query_named("scan_inventory_raw")
def inventory_json_scan(spark, sf):
    """Stock readings written as JSON Lines and read back as text."""
    path = new_shared_path(spark, "inventory-json")
    tables.inventory_raw(spark, sf).drop("partition_date").write.json(path)
    return raw.scan_inventory_raw(spark, path).withColumn(
        "last_updated", F.round(F.col("last_updated").cast("double"), 3)
    )


def _documents(spark, sf):
    path = new_shared_path(spark, "documents")
    tables.json_documents(spark, sf).write.partitionBy("file_no").text(path)
    return normalize_json_files(spark, path, "raw/batch/inventory-raw/", "2024-01-31")


@query_named("normalize_json_files")
def normalize_json(spark, sf):
    """Records of all sound files, written as JSON Lines and read back."""
    target = new_shared_path(spark, "json-lines")
    files = _documents(spark, sf)
    write_json_lines(files, target)
    files.close()
    lines = with_payload(spark.read.text(target, recursiveFileLookup=True))
    payload = F.col("payload")
    return lines.select(
        field(payload, "$.event_id", "bigint").alias("event_id"),
        field(payload, "$.event_type").alias("event_type"),
        field(payload, "$.note").alias("note"),
        field(payload, "$.props.k", "int").alias("k"),
    )


@query
def normalize_json_status(spark, sf):
    """Files and records per verdict."""
    status = _documents(spark, sf).status
    return status.groupBy("status", "reason").agg(
        F.count(F.lit(1)).alias("files"), F.sum("records_converted").alias("records")
    )


@query_named("manifest_scan")
def manifest_load(spark, sf):
    """Web logs through a manifest; files beside the listed ones are not read."""
    root = new_shared_path(spark, "delivered")
    logs = tables.weblog_json(spark, sf)
    logs.select("value").write.text(f"{root}/listed")
    logs.select("value").write.text(f"{root}/beside")
    listed = (
        spark.read.format("binaryFile")
        .load(f"{root}/listed")
        .select(plain_path(F.col("path")).alias("url"), F.lit(True).alias("mandatory"))
    )
    gone = spark.range(1).select(
        F.lit(f"{root}/listed/gone").alias("url"), F.lit(False).alias("mandatory")
    )
    entries = F.collect_list(F.struct("url", "mandatory")).alias("entries")
    manifest = f"{root}/manifest"
    listed.unionByName(gone).agg(entries).write.json(manifest)
    lines = with_payload(manifest_scan(spark, manifest, f"{root}/listed"))
    return clean.clean_weblog(lines).drop("ingestion_timestamp")


@query
def load_web_logs(spark, sf):
    """Delivered web logs into their stream table, by manifest and JSONPaths file, twice over."""
    root = new_shared_path(spark, "load")
    logs = tables.weblog_delivered(spark, sf).select(F.col("flat").alias("value"))
    logs.write.text(f"{root}/listed")
    paths = F.array(*[F.lit(c.path) for c in TABLES["web_logs_stream"]]).alias("jsonpaths")
    spark.range(1).select(paths).write.json(f"{root}/jsonpaths")
    write_manifest(spark, f"{root}/listed", f"{root}/manifest")
    load = (spark, "web_logs_stream", f"{root}/manifest", f"{root}/listed", f"{root}/jsonpaths", root)
    load_stream(*load)
    return load_stream(*load)


# --- the same feeds as streams that work off what is there and stop


def _delivered(spark, path, columns):
    text = spark.read.text(path, recursiveFileLookup=True)
    payload = F.col("payload")
    kinds = {"event_timestamp": "timestamp", "customer_id": "int", "rating": "int"}
    return with_payload(text).select(
        *[field(payload, f"$.{c}", kinds.get(c, "string")).alias(c) for c in columns]
    )


def _stream(spark, sf, kind, lines):
    root = new_shared_path(spark, f"stream-{kind}")
    lines.select("value").write.text(f"{root}/in")
    run_feed(
        spark, kind, f"{root}/in", f"{root}/out", f"{root}/checkpoint", by="event_timestamp"
    ).awaitTermination()
    return f"{root}/out"


_WEBLOG = [c for c in clean.WEBLOG_COLUMNS if c != "ingestion_timestamp"]
_CRM = [c for c in clean.CRM_COLUMNS if c != "ingestion_timestamp"]


@query
def stream_weblogs(spark, sf):
    out = _stream(spark, sf, "web-logs", tables.weblog_json(spark, sf))
    return _delivered(spark, f"{out}/delivered/web-logs", _WEBLOG)


@query
def stream_weblogs_invalid(spark, sf):
    out = _stream(spark, sf, "web-logs", tables.weblog_json(spark, sf))
    schema = "session_id string, user_id string, event_type string, page string"
    return spark.read.schema(schema).json(f"{out}/invalid/web-logs").drop("batch_id")


@query
def delivered_load(spark, sf):
    """Web logs through the feed in two batches, and from its manifests into the stream table."""
    root = new_shared_path(spark, "delivered-load")
    lines = tables.weblog_json(spark, sf)
    lines.select("value").repartition(2).write.text(f"{root}/in")
    run_feed(
        spark, "web-logs", f"{root}/in", f"{root}/out", f"{root}/checkpoint",
        by="event_timestamp", max_files=1,
    ).awaitTermination()
    paths = F.array(*[F.lit(f"$.{c.name}") for c in TABLES["web_logs_stream"]]).alias("jsonpaths")
    spark.range(1).select(paths).write.json(f"{root}/jsonpaths")
    for batch in (0, 1):
        loaded = load_stream(
            spark, "web_logs_stream", manifest_path(f"{root}/out", "web-logs", batch),
            f"{root}/out/delivered", f"{root}/jsonpaths", root,
        )
    return loaded.drop("ingestion_timestamp")


@query
def stream_transform_records(spark, sf):
    """The delivery hook as a stream of several batches, both verdicts read back."""
    root = new_shared_path(spark, "hook")
    came = tables.envelopes(spark, sf)
    came.repartition(3, "recordId").write.json(f"{root}/in")
    run_hook(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", max_files=1).awaitTermination()
    both = [spark.read.schema(HOOKED).json(f"{root}/out/{name}") for name in ("transformed", "failed")]
    return held_against(both[0].unionByName(both[1]).select("recordId", "result", "data"), came)


@query
def stream_crm(spark, sf):
    out = _stream(spark, sf, "crm", tables.crm_json(spark, sf))
    return _delivered(spark, f"{out}/delivered/crm", _CRM)


@query_named("archive_raw_payload")
def stream_archive(spark, sf):
    """The raw text kept beside the cleaned records."""
    out = _stream(spark, sf, "crm", tables.crm_json(spark, sf))
    lines = with_payload(spark.read.text(f"{out}/raw/crm").select("value"))
    role = field(F.col("payload"), "$.interaction_type")
    return lines.groupBy(role.alias("interaction_type")).count()


@query
def time_partitioned_delivery(spark, sf):
    """Rows per delivery folder."""
    out = _stream(spark, sf, "web-logs", tables.weblog_json(spark, sf))
    parts = list(delivery_parts(F.lit(None)))
    folders = spark.read.option("basePath", f"{out}/delivered/web-logs").schema(
        "value string, year string, month string, day string, hour string, batch_id long"
    )
    return folders.text(f"{out}/delivered/web-logs").groupBy(*parts).count()


@query
def repeated_delivery(spark, sf):
    """One batch delivered twice, the second time an hour later: rows per folder."""
    from shelfline.queries.feeds import clean_weblog
    from shelfline.streaming.feeds import deliver

    out = new_shared_path(spark, "repeated")
    rows = clean.valid_weblogs(clean_weblog(spark, sf))
    for hours in (0, 1):
        at = F.col("event_timestamp") + F.make_dt_interval(hours=F.lit(hours))
        deliver(rows.withColumn("at", at), out, _WEBLOG, "at", 7)
    folders = spark.read.schema(
        "value string, year string, month string, day string, hour string, batch_id long"
    )
    return folders.text(out).groupBy(*delivery_parts(F.lit(None))).count()


@query_named("incremental_scan")
def incremental_lines(spark, sf):
    """Two runs over a growing folder: the second reads the new files only."""
    root = new_shared_path(spark, "incremental")
    logs, crm = tables.weblog_json(spark, sf), tables.crm_json(spark, sf)
    for lines in (logs, crm):
        lines.select("value").write.mode("append").text(f"{root}/in")
        incremental_scan(
            spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint"
        ).awaitTermination()
    kind = F.when(F.col("value").contains('"customer_id"'), "crm").otherwise("web-logs")
    return spark.read.parquet(f"{root}/out").groupBy(kind.alias("feed")).count()


@query
def stream_bucket_agg(spark, sf):
    """Two-hour sales cells of a stream in three runs, open windows and late rows included."""
    from shelfline.functions.columns import money
    from shelfline.queries.batch import pos_silver

    root = new_shared_path(spark, "stream-cells")
    rows = pos_silver(spark, sf)
    rows.write.parquet(f"{root}/rows")
    for part in range(3):
        sent = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == part
        spark.read.parquet(f"{root}/rows").filter(sent).write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        try:
            run_cells(source, f"{root}/out", f"{root}/checkpoint")
        except LateRows:
            pass  # they are put aside, and the cells below count them in
    cells = latest_cells(spark, f"{root}/out")
    listed = F.array_join(F.col("store_list").cast("array<string>"), ",")
    return cells.withColumns(
        {c: money(F.col(c)) for c in ("total_revenue", "total_discount")}
    ).withColumn("store_list", listed)


@query
def stream_inventory_dedup(spark, sf):
    """The latest stock readings of a stream in three batches; one of them comes twice."""
    from shelfline.queries.batch import inventory_enriched
    from shelfline.streaming.dedup import latest_rows, run_latest

    root = new_shared_path(spark, "stream-dedup")
    rows = inventory_enriched(spark, sf)
    rows.repartition(3, "warehouse_id").write.parquet(f"{root}/in")
    spark.read.parquet(f"{root}/in").filter("warehouse_id = 1").coalesce(1).write.mode("append").parquet(f"{root}/in")
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    latest = ([PROCESSING_DATE, INVENTORY.key], "last_updated")
    run_latest(source, *latest, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return latest_rows(spark, f"{root}/out", rows.schema, *latest)
