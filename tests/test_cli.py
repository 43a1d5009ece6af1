import json

import pytest

from shelfline.cli import parser, run
from shelfline.model import INVENTORY
from shelfline.operators.validate import missing_columns
from shelfline.plans.batch import MissingColumns
from shelfline.plans.kpi import PartialFailure
from shelfline.sources.catalog import register_tables
from shelfline.sources.raw import scan_inventory_raw
from tests.test_jobs import write_raw


def test_batch_jobs_and_tables(spark, tmp_path):
    write_raw(tmp_path / "raw")
    base = str(tmp_path / "lake")
    days = ["--base", base, "--start", "2025-07-20", "--end", "2025-07-21"]
    pos = run(spark, ["pos", "--raw", str(tmp_path / "raw/pos"), *days])
    assert {r.pos_kept for r in pos.collect()} == {3}
    assert register_tables(spark, base) == ["pos_daily"]
    run(spark, ["inventory", "--raw", str(tmp_path / "raw/inventory"), *days])
    figures = run(spark, ["kpi", *days, "--run-id", "r7"])
    assert {r.status for r in figures.collect()} == {"SUCCESS"}
    assert len(register_tables(spark, base)) == 5
    rows = spark.sql("SELECT * FROM sales_kpi_daily LIMIT 10").collect()
    assert len(rows) == 2 and {r.job_run_id for r in rows} == {"r7"}
    assert run(spark, ["kpi", "--base", base]) is None  # the log shows no day still to do
    with pytest.raises(PartialFailure):
        run(spark, ["kpi", "--base", base, "--processing-date", "2025-07-25"])


def test_normalize_job(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.json").write_text(json.dumps([{"inventory_id": 1}, {"inventory_id": 2}], indent=1))
    args = ["normalize", "--raw", str(source), "--out", str(out), "--processing-date", "2025-07-20"]
    run(spark, args)
    rows = scan_inventory_raw(spark, str(out / "raw/batch/inventory-raw"))
    assert sorted(r.inventory_id for r in rows.collect()) == ["1", "2"]
    (source / "b.json").write_text("{oops")
    with pytest.raises(RuntimeError, match="b.json"):
        run(spark, args)
    found = scan_inventory_raw(spark, str(out / "raw/batch/inventory-raw"), infer=True)
    assert "product_id" in missing_columns(found, INVENTORY)


def test_feed_job(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a").write_text('{"customer_id":"3.7","rating":9,"timestamp":1752784836}\n')
    run(spark, ["feed", "--kind", "crm", "--raw", str(source), "--out", str(tmp_path / "out"),
                "--checkpoint", str(tmp_path / "checkpoint")])
    got = spark.read.text(str(tmp_path / "out/delivered/crm"), recursiveFileLookup=True)
    assert json.loads(got.first().value)["customer_id"] == 3


def test_bad_arguments():
    for argv in ([], ["pos"], ["feed", "--kind", "other"]):
        with pytest.raises(SystemExit):
            parser().parse_args(argv)


def test_daily_runs_take_their_own_files(spark, tmp_path):
    """The second day's run leaves the first day's file alone; a file of no day is rejected."""
    raw, base = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    record = {"inventory_id": 1, "product_id": 2, "warehouse_id": 3, "stock_level": 4,
              "restock_threshold": 1, "last_updated": 1752999000.5}
    for n, name in enumerate(("2025-07-20_stock.json", "stock_20250721.json")):
        (raw / name).write_text(json.dumps(record | {"inventory_id": n}) + "\n{broken\n")
        args = ["inventory", "--raw", str(raw), "--base", base, "--run-id", f"r{n}"]
        got = run(spark, [*args, "--processing-date", f"2025-07-2{n}"]).first()
        assert (got.inventory_rows_in, got.inventory_kept, got.inventory_invalid) == (2, 1, 1)
    (raw / "stock.json").write_text(json.dumps(record))
    got = run(spark, [*args, "--processing-date", "2025-07-21"]).first()
    assert (got.inventory_rows_in, got.inventory_kept) == (3, 1)
    errors = spark.read.json(f"{base}/errors/validation").collect()
    assert sorted((r.job_run_id, r.error_reason, r.raw_line) for r in errors) == [
        ("r0", "Rule violation for last_updated", "{broken"),
        ("r1", "No processing date in folder or file name", None),
        ("r1", "Rule violation for last_updated", "{broken"),
    ]


def test_missing_inventory_field_fails_the_job(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "2025-07-20_a.json").write_text('{"inventory_id": 1, "product_id": 2}')
    args = ["--base", str(tmp_path / "lake"), "--processing-date", "2025-07-20"]
    with pytest.raises(MissingColumns, match="stock_level"):
        run(spark, ["inventory", "--raw", str(raw), *args])


def test_load_job(spark, tmp_path):
    """Files of a manifest into a table, each manifest once; paths and columns must be as many."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"e":"view","t":1752784836.5,"user":7}\n')
    (tmp_path / "in/other.json").write_text('{"e":"not listed"}\n')
    url = str(tmp_path / "in/a.json")
    (tmp_path / "manifest").write_text(json.dumps({"entries": [{"url": url, "mandatory": True}]}))
    (tmp_path / "paths").write_text(json.dumps({"jsonpaths": ["$.e"] + ["$.user"] * 5 + ["$.t"] * 2}, indent=1))
    args = ["load", "--table", "web_logs_stream", "--manifest", str(tmp_path / "manifest"), "--root",
            str(tmp_path / "in"), "--jsonpaths", str(tmp_path / "paths"), "--base", str(tmp_path)]
    def loaded():
        run(spark, args)
        rows = spark.read.parquet(str(tmp_path / "stream/web_logs_stream")).collect()
        return sorted((r.event_type, r.user_id) for r in rows)

    assert loaded() == loaded() == [("view", "7")]
    # Another manifest adds its files; what it lists counts, not its name or order.
    (tmp_path / "in/b.json").write_text('{"e":"click","user":8}\n')
    other = {"entries": [{"url": str(tmp_path / "in/b.json"), "mandatory": False}]}
    (tmp_path / "manifest").write_text(json.dumps(other))
    assert loaded() == loaded() == [("click", "8"), ("view", "7")]
    (tmp_path / "paths").write_text('{"jsonpaths": ["$.e"]}')
    with pytest.raises(ValueError, match="1 paths for 8 columns"):
        run(spark, args)
