import base64
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfline.operators import cells, clean
from shelfline.sources.responses import with_first_record
from shelfline.streaming.cells import LateRows, late_rows, latest_cells, run_cells
from shelfline.sources.manifest import manifest_scan
from shelfline.streaming.dedup import latest_rows, run_latest
from shelfline.streaming.feeds import (
    deliver,
    incremental_scan,
    manifest_path,
    run_feed,
    run_hook,
    write_batch,
)

T0 = 1752784836


def weblog(i, **change):
    row = {"session_id": f"s{i}", "user_id": i, "page": "/p", "event_type": "view",
           "timestamp": T0 + i * 1800}
    return json.dumps({**row, **change})


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def delivered(spark, path):
    df = spark.read.text(str(path), recursiveFileLookup=True)
    return sorted((json.loads(r.value) for r in df.collect()), key=lambda r: r["session_id"])


def feed(spark, tmp_path, **more):
    run_feed(
        spark, "web-logs", str(tmp_path / "in"), str(tmp_path / "out"),
        str(tmp_path / "checkpoint"), by="event_timestamp", **more
    ).awaitTermination()


def test_stream_equals_batch_and_restart_adds_only_new_files(spark, tmp_path):
    put(tmp_path / "in", "a", weblog(1), weblog(2), weblog(3, user_id=None), "{broken")
    put(tmp_path / "in", "b", weblog(4), "[" + weblog(5) + "," + weblog(6) + "]", "[]", "7")
    feed(spark, tmp_path, max_files=1)
    out = tmp_path / "out"
    assert [r["session_id"] for r in delivered(spark, out / "delivered/web-logs")] == [
        "s1", "s2", "s4", "s5"
    ]
    put(tmp_path / "in", "c", weblog(8))
    feed(spark, tmp_path, max_files=1)
    streamed = delivered(spark, out / "delivered/web-logs")
    assert [r["session_id"] for r in streamed] == ["s1", "s2", "s4", "s5", "s8"]

    batch = spark.read.text(str(tmp_path / "in"))
    rows = clean.valid_weblogs(clean.clean_weblog(with_first_record(batch)))
    want = {r.session_id: r for r in rows.collect()}
    assert set(want) == {r["session_id"] for r in streamed}
    for r in streamed:
        assert list(r) == clean.WEBLOG_COLUMNS
        assert datetime.fromisoformat(r["event_timestamp"]) == want[r["session_id"]].event_timestamp
    invalid = spark.read.json(str(out / "invalid/web-logs"))
    assert [r.session_id for r in invalid.collect()] == ["s3"]
    errors = spark.read.json(str(out / "errors/web-logs"))
    assert sorted(r.value for r in errors.collect()) == ["7", "[]", "{broken"]
    raw = spark.read.text(str(out / "raw/web-logs"))
    assert raw.count() == batch.count()


def test_delivery_folders(spark, tmp_path):
    put(tmp_path / "in", "a", weblog(1), weblog(4))
    feed(spark, tmp_path)
    root = tmp_path / "out/delivered/web-logs"
    hours = sorted(str(p.relative_to(root)) for p in root.glob("batch_id=0/year=*/month=*/day=*/hour=*"))
    assert [h.split("/", 1)[1] for h in hours] == [
        "year=2025/month=07/day=17/hour=21", "year=2025/month=07/day=17/hour=22"
    ]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    for lines in ([weblog(1), weblog(2)], [weblog(1), weblog(2)]):
        batch = spark.createDataFrame([(v,) for v in lines], "value string")
        write_batch(batch, 0, "web-logs", out, by="event_timestamp")
    other = spark.createDataFrame([(weblog(3),)], "value string")
    write_batch(other, 1, "web-logs", out, by="event_timestamp")
    got = delivered(spark, f"{out}/delivered/web-logs")
    assert [r["session_id"] for r in got] == ["s1", "s2", "s3"]
    assert spark.read.text(f"{out}/raw/web-logs").count() == 3


def test_incremental_scan(spark, tmp_path):
    args = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    put(tmp_path / "in", "a", "1", "2")
    incremental_scan(spark, *args).awaitTermination()
    incremental_scan(spark, *args).awaitTermination()
    put(tmp_path / "in", "b", "3")
    incremental_scan(spark, *args, max_files=1).awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(args[1]).collect()) == ["1", "2", "3"]


def test_processed_files_can_be_archived(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "archive"
    from shelfline.streaming.feeds import read_lines

    for name in ("a", "b"):
        put(source, name, name)
        (
            read_lines(spark, str(source), archive=str(archive))
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start(str(tmp_path / "out"))
            .awaitTermination()
        )
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    assert [p.name for p in archive.rglob("a")] == ["a"]


def test_streamed_cells_equal_batch_cells(spark, tmp_path):
    start = datetime(2025, 7, 20)
    rows = [
        (f"T{i}", i % 3, i % 4, 1 + i % 2, 2.5, None, start + timedelta(minutes=17 * i))
        for i in range(60)
    ]
    df = spark.createDataFrame(
        rows, """transaction_id string, store_id int, product_id int, quantity int,
        revenue float, discount_applied float, transaction_timestamp timestamp"""
    )
    df.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    run_cells(source, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = latest_cells(spark, str(tmp_path / "out"))
    batch = cells.pos_cells(df.withColumn("processing_date", F.lit("2025-07-20").cast("date")))

    def key(df):
        return sorted(
            (r.product_id, r.analysis_date, r.time_bucket, r.total_quantity, r.total_revenue,
             r.transaction_count, r.store_list) for r in df.collect()
        )

    assert key(got) == key(batch) and got.count() > 10


def test_no_cells_before_the_first_batch(spark, tmp_path):
    schema = """transaction_id string, store_id int, product_id int, quantity int,
        revenue float, discount_applied float, transaction_timestamp timestamp"""
    out = str(tmp_path / "out")
    none = latest_cells(spark, out)
    assert none.collect() == []
    rows = [("T1", 1, 1, 1, 1.0, None, datetime(2025, 7, 20, 1))]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    run_cells(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), out, str(tmp_path / "checkpoint"))
    assert latest_cells(spark, out).dtypes == none.dtypes and latest_cells(spark, out).count() == 1


def test_late_rows_are_told(spark, tmp_path):
    schema = """transaction_id string, store_id int, product_id int, quantity int,
        revenue float, discount_applied float, transaction_timestamp timestamp"""

    def put_rows(*hours):
        rows = [(f"T{h}", 1, 1, 1, 1.0, None, datetime(2025, 7, 20, h)) for h in hours]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        run_cells(source, str(tmp_path / "out"), str(tmp_path / "checkpoint"))

    put_rows(1, 20)
    put_rows(20)  # an open window goes on
    cell = {r.time_bucket: r.total_quantity for r in latest_cells(spark, str(tmp_path / "out")).collect()}
    assert cell == {0: 1, 20: 2}
    with pytest.raises(LateRows, match="1 rows"):
        put_rows(2)


def test_late_rows_are_put_aside_and_counted_in(spark, tmp_path):
    """Also when they come in an early batch of a run whose progress is no longer held."""
    schema = """transaction_id string, store_id int, product_id int, quantity int,
        revenue float, discount_applied float, transaction_timestamp timestamp"""
    out, spot = str(tmp_path / "out"), str(tmp_path / "in")
    rows = [(f"T{i}", i, 1, 1, 1.0, None, datetime(2025, 7, 20, h)) for i, h in enumerate((20, 1, 20, 18, 21))]
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(spot)
    held = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        for row in rows:
            spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(spot)
        with pytest.raises(LateRows, match="1 rows"):
            run_cells(source, out, str(tmp_path / "checkpoint"))
        run_cells(source, out, str(tmp_path / "checkpoint"))
        spark.createDataFrame([("T9", 9, 1, 1, 1.0, None, datetime(2025, 7, 20, 0))], schema).coalesce(1).write.mode("append").parquet(spot)
        with pytest.raises(LateRows, match="1 rows"):
            run_cells(source, out, str(tmp_path / "checkpoint"))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", held)
    assert sorted((r.transaction_id, r.batch_id) for r in late_rows(spark, out).collect()) == [("T1", 1), ("T9", 5)]
    got = {r.time_bucket: (r.total_quantity, r.transaction_count, r.store_list) for r in latest_cells(spark, out).collect()}
    assert got == {0: (2, 2, [1, 9]), 18: (1, 1, [3]), 20: (3, 3, [0, 2, 4])}


def test_batch_repeated_in_another_hour_adds_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "page string, user_id int")
    for at in ("2025-07-20 10:59:00", "2025-07-20 11:01:00"):
        deliver(rows.withColumn("ingestion_timestamp", F.lit(at).cast("timestamp")), out, ["page"], "ingestion_timestamp", 4)
    assert spark.read.text(out, recursiveFileLookup=True).count() == 2
    assert [p.name for p in tmp_path.glob("out/batch_id=4/year=2025/month=07/day=20/*")] == ["hour=11"]


def envelope(i, text):
    data = base64.b64encode(text.encode()).decode() if isinstance(text, str) else "@@@"
    return json.dumps({"recordId": f"r{i:03}", "data": data})


def test_hook_keeps_failed_records_and_order(spark, tmp_path):
    good = {i: envelope(i, json.dumps({"customer_id": f"{i}.7", "rating": 9})) for i in range(0, 40, 2)}
    bad = {i: envelope(i, None if i % 3 else "{no json") for i in range(1, 40, 2)}
    both = [(good | bad)[i] for i in range(40)]
    put(tmp_path / "in", "a", *both[::-1][:25])
    args = [spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")]
    run_hook(*args, max_files=1).awaitTermination()
    put(tmp_path / "in", "b", *both[::-1][25:])
    run_hook(*args, max_files=1).awaitTermination()
    schema = "recordId string, result string, data string, batch_id long"
    sent = spark.read.schema(schema).json(str(tmp_path / "out/transformed")).collect()
    failed = spark.read.schema(schema).json(str(tmp_path / "out/failed")).collect()
    assert {r.recordId for r in sent} == {f"r{i:03}" for i in good} and {r.result for r in sent} == {"Ok"}
    assert {json.loads(base64.b64decode(r.data))["customer_id"] for r in sent} == set(good)
    as_sent = {json.loads(e)["recordId"]: json.loads(e)["data"] for e in bad.values()}
    assert {r.recordId: r.data for r in failed} == as_sent
    assert {r.result for r in failed} == {"ProcessingFailed"}
    for name in ("transformed", "failed"):
        for batch in (0, 1):
            files = sorted((tmp_path / f"out/{name}/batch_id={batch}").glob("part-*"))
            ids = [json.loads(line)["recordId"] for f in files for line in f.read_text().splitlines()]
            assert ids and ids == sorted(ids)


def test_a_batch_lists_what_it_delivered(spark, tmp_path):
    put(tmp_path / "in", "a", weblog(1), weblog(9, user_id=None))
    feed(spark, tmp_path)
    put(tmp_path / "in", "b", weblog(2), weblog(50))
    feed(spark, tmp_path)
    put(tmp_path / "in", "c", "{broken")
    feed(spark, tmp_path)
    out = str(tmp_path / "out")
    listed = []
    for n in range(3):
        path = manifest_path(out, "web-logs", n)
        rows = manifest_scan(spark, path, f"{out}/delivered").collect()
        listed.append(sorted(json.loads(r.value)["session_id"] for r in rows))
        for r in spark.read.json(path).selectExpr("inline(entries)").collect() if rows else []:
            assert r.mandatory and r.meta.content_length > 0
    assert listed == [["s1"], ["s2", "s50"], []]


def test_streamed_dedup_loses_nothing_and_keeps_state(spark, tmp_path):
    """Copies across batches, rows of one key that differ, and times far back."""
    schema = "id int, at timestamp, stock int"
    keys, order_by = ["id"], "at"
    batches = [
        [(1, T0, 5), (2, T0, 1), (2, T0, 1)],
        [(1, T0, 5), (1, T0 + 60, 7), (3, T0 - 10**8, 2)],  # a copy, a later one, a very old one
        [(1, T0 + 30, 9), (4, None, 3), (None, T0, 8)],
    ]
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    where = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    written = []
    for part in batches:
        rows = [(i, None if at is None else datetime.fromtimestamp(at), n) for i, at, n in part]
        frame = spark.createDataFrame(rows, schema)
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = run_latest(source, keys, order_by, *where)
        query.awaitTermination()
        operators = [s for p in query.recentProgress for s in p["stateOperators"]]
        assert operators and not sum(s["numRowsDroppedByWatermark"] for s in operators)
        written.append(spark.read.schema(schema).parquet(where[0]).count())
    # The second batch adds two rows, as the copy of the first is known from the state.
    assert written == [2, 4, 7]
    found = {r.id: r.stock for r in latest_rows(spark, where[0], schema, keys, order_by).collect()}
    assert found == {1: 7, 2: 1, 3: 2, 4: 3, None: 8}
