"""The two event feeds under Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.functions.payload import OK, compact_json
from shelfline.operators import clean
from shelfline.session import prepare
from shelfline.sources.manifest import write_manifest
from shelfline.sources.responses import with_first_record

# Per feed: its cleaner and the columns delivered.
CLEANERS = {
    "crm": (clean.clean_crm, clean.CRM_COLUMNS),
    "web-logs": (clean.clean_weblog, clean.WEBLOG_COLUMNS),
}


def read_lines(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New text files as they arrive. ``archive`` moves files there once processed."""
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.text(path)


def incremental_scan(
    spark: SparkSession, path: str, out: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Append the lines of files not seen by an earlier run, then stop."""
    return (
        read_lines(prepare(spark), path, max_files)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def delivery_parts(ts: Column) -> dict[str, Column]:
    """Folders of time-partitioned delivery."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


_PARTS = ["year", "month", "day", "hour"]


def deliver(df: DataFrame, path: str, columns: list[str], by: str, batch_id: int) -> None:
    """One compact JSON object per line, in year/month/day/hour folders of the batch.

    The batch's own folder stands above those of the hours, so that a repeated batch
    replaces all it wrote before, whatever hours it falls into now, and nothing else.
    """
    (
        df.withColumn("value", compact_json(*columns))
        .withColumns(delivery_parts(F.col(by)))
        .select("value", *_PARTS)
        .hint("rebalance", *[F.col(c) for c in _PARTS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*_PARTS)
        .text(f"{path}/batch_id={batch_id}")
    )


def _put_aside(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").json(f"{path}/batch_id={batch_id}")


def write_batch(
    batch: DataFrame, batch_id: int, kind: str, out: str, by: str = "ingestion_timestamp"
) -> None:
    """One micro-batch: archive the raw text, deliver clean records, put the rest aside, and
    list the files delivered in a manifest.

    All outputs come from one parse, held for the batch and recomputed if it is lost.
    """
    cleaner, columns = CLEANERS[kind]
    shape = F.schema_of_variant("payload")
    parsed = with_first_record(batch.select("value")).withColumn(
        "readable", F.coalesce(shape.startswith("OBJECT"), F.lit(False))
    )
    rows = cleaner(parsed, keep=["value", "readable"]).persist()
    try:
        rows.select("value").write.mode("overwrite").text(
            f"{out}/raw/{kind}/batch_id={batch_id}"
        )
        unreadable = rows.filter(~F.col("readable")).select("value")
        _put_aside(unreadable, f"{out}/errors/{kind}", batch_id)
        cleaned = rows.filter("readable").select(*columns)
        if kind == "web-logs":
            _put_aside(clean.invalid_weblogs(cleaned), f"{out}/invalid/{kind}", batch_id)
            cleaned = clean.valid_weblogs(cleaned)
        deliver(cleaned, f"{out}/delivered/{kind}", columns, by, batch_id)
        delivered = f"{out}/delivered/{kind}/batch_id={batch_id}"
        write_manifest(batch.sparkSession, delivered, manifest_path(out, kind, batch_id))
    finally:
        rows.unpersist()


def manifest_path(out: str, kind: str, batch_id: int) -> str:
    """Where the list of the files that a batch delivered lies, for load jobs."""
    return f"{out}/manifests/{kind}/batch_id={batch_id}"


def run_feed(
    spark: SparkSession,
    kind: str,
    path: str,
    out: str,
    checkpoint: str,
    by: str = "ingestion_timestamp",
    max_files: int | None = None,
    trigger: dict | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Start a feed. By default it works off what is there and stops.

    ``archive`` is a folder to which files go once they are processed.
    """
    if kind not in CLEANERS:
        raise ValueError(f"unknown feed: {kind}")
    return (
        read_lines(prepare(spark), path, max_files, archive)
        .writeStream.foreachBatch(lambda df, n: write_batch(df, n, kind, out, by))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


ENVELOPE = "recordId string, data string"
HOOKED = "recordId string, result string, data string"


def transform_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """One micro-batch through the delivery hook, in order of ``recordId``.

    Good records, encoded again, go to ``transformed``; failed ones, as they came, to
    ``failed``. Both come from one run of the hook, held for the batch.
    """
    hooked = clean.transform_records(batch.select("recordId", "data")).persist()
    good = F.col("result") == OK
    try:
        for rows, name in ((hooked.filter(good), "transformed"), (hooked.filter(~good), "failed")):
            # Ranges, then order inside them: files follow each other, and none is sorted whole.
            in_order = rows.repartitionByRange("recordId").sortWithinPartitions("recordId")
            _put_aside(in_order, f"{out}/{name}", batch_id)
    finally:
        hooked.unpersist()


def run_hook(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    max_files: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the delivery hook over files of envelopes, one JSON object of ``recordId`` and
    ``data`` per line. By default it works off what is there and stops."""
    reader = prepare(spark).readStream.schema(ENVELOPE).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.json(path)
        .writeStream.foreachBatch(lambda df, n: transform_batch(df, n, out))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
