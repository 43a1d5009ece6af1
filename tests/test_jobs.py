import gzip
import json
import re
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfline.config import RunConfig, shared_dir, staged
from shelfline.model import INVENTORY, NO_POS_MATCH, POS, SALES_KPI
from shelfline.operators import objects, status
from shelfline.plans.batch import MissingColumns, run_batch, run_landed
from shelfline.plans.days import DaysFailed
from shelfline.plans.kpi import PartialFailure, raise_on_partial_failure, run_kpis
from shelfline.sinks.tables import quarantine, replace_dates
from shelfline.sources.landing import ledger
from shelfline.sources.raw import for_days, scan_inventory_raw, scan_pos_raw
from shelfline.sources.silver import scan_silver

DAYS = [date(2025, 7, 20), date(2025, 7, 21), date(2025, 7, 22)]
HEADER = "transaction_id,store_id,product_id,quantity,revenue,discount_applied,timestamp\n"


def epoch(day, hour):
    return int(datetime(day.year, day.month, day.day, hour, tzinfo=timezone.utc).timestamp())


def write_raw(base: Path):
    """Two days of both feeds; the third day has no rows at all."""
    for n, day in enumerate(DAYS[:2]):
        pos = base / f"pos/partition_date={day}"
        inv = base / f"inventory/partition_date={day}"
        pos.mkdir(parents=True)
        inv.mkdir(parents=True)
        rows = [
            ("T1", 1, 1, 2, 20, 1, epoch(day, 8)),
            ("T1", 1, 1, 3, 30, 1, epoch(day, 9)),  # later copy of T1
            ("T2", 2, 1, 1, 10, "", epoch(day, 8)),
            ("T3", 1, 2, -1, 5, 0, epoch(day, 8)),  # rejected
            ("T4", 1, 9, 1 + n, 8, 0, epoch(day, 8)),  # no stock reading
        ]
        lines = [",".join(map(str, r)) for r in rows]
        (pos / "sales.csv").write_text(HEADER + "\n".join(lines) + "\n")
        stock = [
            dict(inventory_id=1, product_id=1, warehouse_id=5, stock_level=12,
                 restock_threshold=3, last_updated=epoch(day, 8) + 0.5),
            dict(inventory_id=2, product_id=2, warehouse_id=5, stock_level=0,
                 restock_threshold=None, last_updated=epoch(day, 9)),
            dict(inventory_id=3, product_id=3, warehouse_id=5, stock_level=-4,
                 restock_threshold=None, last_updated=epoch(day, 9)),
        ]
        (inv / "stock.json").write_text("\n".join(map(json.dumps, stock)))


@pytest.fixture()
def raw(tmp_path):
    write_raw(tmp_path / "raw")
    return tmp_path / "raw"


def run_all(spark, raw, base, start, end, run_id="r1"):
    cfg = RunConfig(str(base), start, end, run_id)
    pos = run_batch(spark, scan_pos_raw(spark, str(raw / "pos")), POS, cfg)
    inv_raw = scan_inventory_raw(
        spark, str(raw / "inventory"), [*INVENTORY.columns, "partition_date"]
    )
    inv = run_batch(spark, inv_raw, INVENTORY, cfg)
    return cfg, pos, inv, run_kpis(spark, cfg)


def dump(spark, base, *parts, schema=None):
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet("/".join([str(base), *parts]))
    audit = ["job_run_id", "kpi_creation_timestamp", "processed_timestamp_utc",
             "redshift_load_timestamp"]
    return sorted(map(str, df.drop(*audit).collect()))


def test_range_run(spark, raw, tmp_path):
    cfg, pos, inv, figures = run_all(spark, raw, tmp_path / "lake", DAYS[0], DAYS[2])
    seen = {r.processing_date: r for r in pos.collect()}
    for day in DAYS[:2]:
        got = seen[day]
        assert (got.pos_rows_in, got.pos_valid, got.pos_invalid, got.pos_kept) == (5, 4, 1, 3)
    assert seen[DAYS[2]].pos_rows_in == 0
    assert {r.inventory_kept for r in inv.collect()} == {2, 0}
    states = {r.processing_date: r.status for r in figures.collect()}
    assert states == {DAYS[0]: "SUCCESS", DAYS[1]: "SUCCESS", DAYS[2]: "PARTIAL_FAILURE"}
    with pytest.raises(PartialFailure, match="2025-07-22"):
        raise_on_partial_failure(figures)

    sales = spark.read.parquet(cfg.path("kpi", SALES_KPI)).orderBy("processing_date").collect()
    assert [r.total_daily_quantity_sold for r in sales] == [4, 4]
    errors = spark.read.json(cfg.path("errors", "kpi"))
    assert {(r.source_type, r.product_id, r.error_reason) for r in errors.collect()} == {
        ("failed_joins", 2, NO_POS_MATCH)
    }
    rejected = spark.read.json(cfg.path("errors", "validation")).groupBy("source_type").count()
    assert {r.source_type: r["count"] for r in rejected.collect()} == {"pos": 2, "inventory": 2}


def test_range_equals_single_days_and_reruns_change_nothing(spark, raw, tmp_path):
    whole, single = tmp_path / "whole", tmp_path / "single"
    run_all(spark, raw, whole, DAYS[0], DAYS[1])
    for day in DAYS[:2]:
        run_all(spark, raw, single, day, day)
    tables = [("silver", "pos"), ("silver", "inventory"), ("kpi", "sales_kpi_daily"),
              ("kpi", "inventory_kpi_daily"), ("kpi", "regional_kpi_daily")]
    first = {t: dump(spark, whole, *t) for t in tables}
    assert first == {t: dump(spark, single, *t) for t in tables}
    assert all(first.values())
    run_all(spark, raw, whole, DAYS[0], DAYS[1], "r2")
    assert first == {t: dump(spark, whole, *t) for t in tables}


def test_day_without_sales_is_skipped(spark, raw, tmp_path):
    """Such a day fails without reporting its stock readings as unmatched."""
    cfg = RunConfig(str(tmp_path / "lake"), DAYS[0], DAYS[1], "r1")
    inv_raw = scan_inventory_raw(spark, str(raw / "inventory"))
    run_batch(spark, inv_raw, INVENTORY, cfg)
    first_day = RunConfig(cfg.base, DAYS[0], DAYS[0], "r1")
    run_batch(spark, scan_pos_raw(spark, str(raw / "pos")), POS, first_day)
    states = {r.processing_date: r.status for r in run_kpis(spark, cfg).collect()}
    assert states == {DAYS[0]: "SUCCESS", DAYS[1]: "PARTIAL_FAILURE"}
    errors = spark.read.json(cfg.path("errors", "kpi")).collect()
    assert {str(r.processing_date) for r in errors} == {str(DAYS[0])}


def test_missing_column_fails_after_quarantine(spark, raw, tmp_path):
    cfg = RunConfig(str(tmp_path / "lake"), DAYS[0], DAYS[0], "r1")
    broken = scan_pos_raw(spark, str(raw / "pos")).drop("store_id")
    with pytest.raises(MissingColumns, match="store_id"):
        run_batch(spark, broken, POS, cfg)
    errors = spark.read.json(cfg.path("errors", "validation", "source_type=pos"))
    assert errors.count() == 5 and "Missing critical" in errors.first().error_reason


def test_dates(spark):
    assert RunConfig.of("b", start="2024-02-28", end="2024-03-01").days == [
        date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)
    ]
    assert RunConfig.of("b", "2025-07-20").days == [DAYS[0]]
    assert RunConfig.of("b").days == [datetime.now(timezone.utc).date()]
    both = RunConfig.of("b", "2025-07-20", "2025-07-21", "2025-07-22")
    assert both.days == DAYS[1:]
    with pytest.raises(ValueError):
        RunConfig.of("b", start="2025-07-21", end="2025-07-20")
    with pytest.raises(ValueError):
        RunConfig.of("b", "20/07/2025")


def test_raw_days_prune_folders(spark, raw):
    df = for_days(scan_pos_raw(spark, str(raw / "pos")), DAYS[1], DAYS[1])
    assert {r.processing_date for r in df.collect()} == {DAYS[1]}
    assert len(df.select("transaction_id", F.input_file_name()).distinct().collect()) == 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*partition_date", plan)
    bare = spark.createDataFrame([("a",)], "transaction_id string")
    assert for_days(bare, DAYS[0], DAYS[0]).first().processing_date == DAYS[0]
    with pytest.raises(ValueError):
        for_days(bare, DAYS[0], DAYS[1])


def test_silver_scan_prunes_and_guards(spark, raw, tmp_path):
    cfg = RunConfig(str(tmp_path / "lake"), DAYS[0], DAYS[1], "r1")
    run_batch(spark, scan_pos_raw(spark, str(raw / "pos")), POS, cfg)
    one = scan_silver(spark, cfg.path("silver"), "pos", DAYS[0], DAYS[0])
    assert one.count() == 3
    assert "PartitionFilters: [isnotnull(processing_date" in (
        one._jdf.queryExecution().executedPlan().toString()
    )
    assert scan_silver(spark, cfg.path("none"), "pos", DAYS[0], DAYS[0]).count() == 0
    with pytest.raises(ValueError):
        scan_silver(spark, cfg.path("silver"), "other", DAYS[0], DAYS[0])


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_replace_dates(spark, tmp_path, fmt):
    path = str(tmp_path / "t")

    def rows(*pairs):
        return spark.createDataFrame(pairs, "v int, processing_date date")

    def stored():
        df = spark.read.schema("v int, processing_date date").format(fmt).load(path)
        return sorted((r.v, r.processing_date) for r in df.collect())

    replace_dates(rows((1, DAYS[0]), (2, DAYS[1]), (3, DAYS[2])), path, DAYS, fmt)
    replace_dates(rows((20, DAYS[1])), path, DAYS[1:2], fmt)
    assert stored() == [(1, DAYS[0]), (3, DAYS[2]), (20, DAYS[1])]
    replace_dates(rows((30, DAYS[2])), path, DAYS[1:], fmt)
    assert stored() == [(1, DAYS[0]), (30, DAYS[2])]
    replace_dates(rows((9, DAYS[0])).limit(0), path, DAYS, fmt)
    assert stored() == []


def test_quarantine_stamps(spark, tmp_path):
    rows = spark.createDataFrame([("x", DAYS[0])], "error_reason string, processing_date date")
    quarantine(rows, str(tmp_path / "e"), "pos", "run-1", DAYS[:1])
    got = spark.read.json(str(tmp_path / "e")).first()
    assert got.source_type == "pos" and got.job_run_id == "run-1"
    assert got.processing_date_of_error == "2025-07-20" and got.error_timestamp_utc


def test_staging_uses_the_named_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    with staged(spark.range(3).toDF("n"), "t") as df:
        assert df.count() == 3
        files = df.inputFiles()
        assert all(f.replace("file://", "").startswith(named) for f in files)
        assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert not any(Path(f.replace("file://", "")).exists() for f in files)


def test_object_keys(spark):
    keys = [
        "pos/2025-07-20_sales_20250720.csv", "inventory/2025-07-20_stock.json",
        "pos/2025-07-20_sales.json", "pos/2025-07-20_north+a%20b_20250721.CSV",
        "raw/batch/pos-raw/x_20250720.csv", "bad%zz.csv",
    ]
    df = spark.createDataFrame([(k,) for k in keys], "object_key string")
    routed = {r.object_key: r for r in objects.route_by_type(objects.path_metadata(df)).collect()}
    a = routed[keys[0]]
    assert (a.data_type, a.file_extension, a.processing_date, a.route) == (
        "pos", "csv", "2025-07-20", "pos")
    assert routed[keys[1]].route == "inventory"
    assert routed[keys[2]].route == "invalid_input"
    landed = {r.object_key: r for r in objects.land_csv(df).collect()}
    assert landed[keys[1]].status == "skipped" and landed[keys[1]].output_location is None
    assert landed[keys[3]].output_location == (
        "raw/batch/pos-raw/2025-07-20_north a b_20250721.CSV")
    assert landed[keys[4]].status == "already_in_destination"
    assert landed[keys[5]].output_location == "raw/batch/pos-raw/bad%zz.csv"
    moved = objects.archive_candidates(df, POS, DAYS[0], DAYS[0]).collect()
    assert {r.object_key: r.archive_key for r in moved} == {
        keys[4]: "archive/pos/2025-07-20/x_20250720.csv",
    }
    assert objects.archive_candidates(df, INVENTORY, DAYS[0], DAYS[0]).count() == 0


def test_tables_can_be_listed(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("web_logs_stream")
    assert "web_logs_stream" in [t.name for t in spark.catalog.listTables()]


def test_one_bad_file_fails_its_day_alone(spark, tmp_path):
    """A truncated file among eight days: seven are stored, the log names the eighth."""
    days = [date(2025, 7, 1) + timedelta(n) for n in range(8)]
    bad = days[5]
    for day in days:
        folder = tmp_path / f"raw/partition_date={day}"
        folder.mkdir(parents=True)
        row = dict(inventory_id=1, product_id=1, warehouse_id=5, stock_level=12,
                   restock_threshold=3, last_updated=epoch(day, 8))
        packed = gzip.compress("\n".join([json.dumps(row)] * 50).encode())
        (folder / "stock.json.gz").write_bytes(packed[:-20] if day == bad else packed)
    cfg = RunConfig(str(tmp_path / "lake"), days[0], days[-1], "r1")
    with pytest.raises(DaysFailed, match=str(bad)) as caught:
        run_landed(spark, INVENTORY, str(tmp_path / "raw"), cfg)
    assert set(caught.value.failed) == {bad}
    rest = set(days) - {bad}
    assert {r.processing_date: r.inventory_kept for r in caught.value.outcome.collect()} == {d: 1 for d in rest}
    kept = scan_silver(spark, cfg.path("silver"), "inventory", cfg.start, cfg.end).collect()
    assert {r.processing_date for r in kept} == rest and len(kept) == len(rest)
    states = status.current_status(spark.read.parquet(cfg.path("runs", "log"))).collect()
    told = {r.processing_date: r.inventory_transform_status for r in states}
    assert told == {d: "FAILED" if d == bad else "COMPLETED" for d in days}
    files = ledger(spark, cfg.base).collect()
    assert sorted(r.day for r in files) == sorted(rest)


def test_other_errors_mark_all_days(spark, raw, tmp_path, monkeypatch):
    cfg = RunConfig(str(tmp_path / "lake"), DAYS[0], DAYS[1], "r1")
    monkeypatch.setattr("shelfline.plans.batch.to_silver", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_batch(spark, scan_pos_raw(spark, str(raw / "pos")), POS, cfg)
    log = spark.read.parquet(cfg.path("runs", "log")).collect()
    assert {(r.processing_date, r.status) for r in log} == {(d, "FAILED") for d in DAYS[:2]}
