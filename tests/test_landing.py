"""Which files a run opens, and what finished runs remember."""

import json
import os
from datetime import date

import pytest

from shelfline.config import RunConfig
from shelfline.model import INVENTORY, POS
from shelfline.plans.batch import MissingColumns, run_landed
from shelfline.sources import landing
from shelfline.sources.manifest import exist, listed_files
from tests.test_jobs import HEADER, epoch, write_raw

DAYS = [date(2025, 7, 20), date(2025, 7, 21), date(2025, 7, 22)]


def sale(folder, name, day, *ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join(f"{i},1,1,1,9.5,0,{epoch(day, 8)}\n" for i in ids))


def taken(spark, folder, cfg, feed=POS):
    rows = landing.files_to_take(spark, feed, str(folder), cfg).collect()
    return sorted(os.path.basename(r.file) for r in rows)


def test_a_run_opens_its_own_files_only(spark, tmp_path, monkeypatch):
    opened = []
    scan = landing.scan_files

    def watched(*args):
        df = scan(*args)
        opened.append(sorted(os.path.basename(f) for f in df.inputFiles()))
        return df

    monkeypatch.setattr("shelfline.plans.batch.scan_files", watched)
    raw, base = tmp_path / "raw", str(tmp_path / "lake")
    for n, day in enumerate(DAYS):
        sale(raw, f"{day}_sales.csv", day, f"A{n}")
        sale(raw, f"till_{day:%Y%m%d}.CSV", day, f"B{n}")
        outcome = run_landed(spark, POS, str(raw), RunConfig(base, day, day, f"r{n}")).first()
        assert (outcome.pos_rows_in, outcome.pos_kept) == (2, 2)
        assert opened[n] == [f"{day}_sales.csv", f"till_{day:%Y%m%d}.CSV"]
    assert spark.read.parquet(f"{base}/silver/pos").count() == 6
    # A late file of an earlier day: the day is run again, from all of its files.
    sale(raw, f"{DAYS[0]}_late.csv", DAYS[0], "C0")
    run_landed(spark, POS, str(raw), RunConfig(base, DAYS[0], DAYS[0], "r9"))
    assert opened[3] == ["2025-07-20_late.csv", "2025-07-20_sales.csv", "till_20250720.CSV"]
    assert spark.read.parquet(f"{base}/silver/pos").count() == 7
    kept = landing.ledger(spark, base).filter("job_run_id = 'r9'").collect()
    assert {(os.path.basename(r.file), r.day) for r in kept} == {(name, DAYS[0]) for name in opened[3]}


def test_the_plan_reads_as_many_files_as_the_run_takes(spark, tmp_path):
    for day in DAYS:
        sale(tmp_path / "raw", f"{day}_sales.csv", day, "A")
    names = [f"{tmp_path}/raw/{DAYS[2]}_sales.csv"]
    df = landing.scan_files(spark, POS, str(tmp_path / "raw"), names)
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    scans = plan.collectLeaves()
    assert [scans.apply(i).metrics().apply("numFiles").value() for i in range(scans.size())] == [1]


def test_files_of_no_day_are_rejected_once(spark, tmp_path):
    raw, base = tmp_path / "raw", str(tmp_path / "lake")
    sale(raw, "sales.csv", DAYS[0], "A")
    configs = [RunConfig(base, day, day, f"r{n}") for n, day in enumerate(DAYS)]
    for n in (0, 0, 1):  # the first run is repeated, as after a failure
        run_landed(spark, POS, str(raw), configs[n])
    errors = spark.read.json(f"{base}/errors/validation").collect()
    assert [(r.job_run_id, r.transaction_id) for r in errors] == [("r0", "A")]
    assert taken(spark, raw, configs[1]) == [] and taken(spark, raw, configs[0]) == ["sales.csv"]
    os.utime(raw / "sales.csv", (1, 1))  # it changed
    assert taken(spark, raw, configs[1]) == ["sales.csv"]


def test_folders_names_and_empty_days(spark, tmp_path):
    write_raw(tmp_path / "raw")
    cfg = RunConfig(str(tmp_path / "lake"), DAYS[1], DAYS[2], "r1")
    pos = {r.processing_date: r.pos_kept for r in run_landed(spark, POS, str(tmp_path / "raw/pos"), cfg).collect()}
    assert pos == {DAYS[1]: 3, DAYS[2]: 0}
    inventory = run_landed(spark, INVENTORY, str(tmp_path / "raw/inventory"), cfg)
    assert {r.inventory_kept for r in inventory.collect()} == {2, 0}
    odd = tmp_path / "odd"
    sale(odd, "a [1] {b}*_20250722.csv", DAYS[2], "X", "Y")
    sale(odd, "empty_20250721.csv", DAYS[1])
    (odd / "nothing_20250721.csv").write_text("")
    got = {r.processing_date: r.pos_kept for r in run_landed(spark, POS, str(odd), cfg).collect()}
    assert got == {DAYS[1]: 0, DAYS[2]: 2}
    later = RunConfig(cfg.base, date(2025, 8, 1), date(2025, 8, 1), "r2")
    assert run_landed(spark, POS, str(odd), later).first().pos_rows_in == 0


def test_listed_paths_are_asked_for_themselves(spark, tmp_path, monkeypatch):
    data = tmp_path / "data"
    data.mkdir()
    for n in range(30):
        (data / f"f{n}").write_text("x\n")
    (tmp_path / "beside").write_text("x\n")
    urls = [f"file://{data}/f3", f"{data}/f3", f"{data}/gone", f"{tmp_path}/beside"]
    entries = [{"url": u, "mandatory": n == 1} for n, u in enumerate(urls)]
    (tmp_path / "manifest").write_text(json.dumps({"entries": entries}))
    asked = []

    def counted(spark, paths):
        asked.extend(paths)
        return exist(spark, paths)

    monkeypatch.setattr("shelfline.sources.manifest.exist", counted)
    found = listed_files(spark, str(tmp_path / "manifest"), str(data))
    assert asked == [f"{data}/f3", f"{data}/gone"]
    assert [tuple(f) for f in found] == [
        (f"{tmp_path}/beside", False, False), (f"{data}/f3", True, True), (f"{data}/gone", False, False)
    ]


def below(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and p.name[0] != ".")


def test_files_of_stored_days_are_archived_and_read_again(spark, tmp_path):
    raw, kept, base = tmp_path / "raw", tmp_path / "old", str(tmp_path / "lake")

    def go(run_id, first, last):
        run_landed(spark, POS, str(raw), RunConfig(base, first, last, run_id), str(kept))
        rows = spark.read.parquet(f"{base}/silver/pos").collect()
        return sorted((r.processing_date, r.transaction_id) for r in rows)

    sale(raw, f"{DAYS[0]}_sales.csv", DAYS[0], "A", "B")
    sale(raw, f"till_{DAYS[1]:%Y%m%d}.csv", DAYS[1], "C")
    sale(raw, "a [1] of no day.csv", DAYS[1], "N")
    raw.joinpath(f"partition_date={DAYS[2]}").mkdir()
    sale(raw / f"partition_date={DAYS[2]}", "s{1}.csv", DAYS[2], "D")
    rows = [(DAYS[0], "A"), (DAYS[0], "B"), (DAYS[1], "C")]
    assert go("r1", DAYS[0], DAYS[1]) == rows
    assert below(kept) == [f"pos/{DAYS[0]}_sales.csv", f"pos/till_{DAYS[1]:%Y%m%d}.csv"]
    assert below(raw) == ["a [1] of no day.csv", f"partition_date={DAYS[2]}/s{{1}}.csv"]
    # A late file and one that came again: the day's other file comes from the archive.
    sale(raw, f"{DAYS[0]}_late.csv", DAYS[0], "E")
    sale(raw, f"till_{DAYS[1]:%Y%m%d}.csv", DAYS[1], "C2")
    rows = [(DAYS[0], "A"), (DAYS[0], "B"), (DAYS[0], "E"), (DAYS[1], "C2"), (DAYS[2], "D")]
    assert go("r2", DAYS[0], DAYS[2]) == rows
    assert below(raw) == ["a [1] of no day.csv"]
    assert below(kept) == sorted(
        [f"pos/{DAYS[0]}_late.csv", f"pos/{DAYS[0]}_sales.csv", f"pos/till_{DAYS[1]:%Y%m%d}.csv",
         f"pos/partition_date={DAYS[2]}/s{{1}}.csv"]
    )
    # With all files in the archive, running again changes nothing.
    assert go("r3", DAYS[0], DAYS[2]) == rows
    errors = spark.read.json(f"{base}/errors/validation").collect()
    assert [(r.job_run_id, r.transaction_id) for r in errors] == [("r1", "N")]


def test_folders_of_days_beside_plain_files(spark, tmp_path):
    """Rows of both are taken, each by its own day."""
    (tmp_path / "raw").mkdir()
    sale(tmp_path / "raw", f"{DAYS[0]}_a.csv", DAYS[0], "A")
    sale(tmp_path / "raw" / f"partition_date={DAYS[1]}", "b.csv", DAYS[1], "B")
    cfg = RunConfig(str(tmp_path / "lake"), DAYS[0], DAYS[1], "r")
    run_landed(spark, POS, str(tmp_path / "raw"), cfg)
    rows = spark.read.parquet(cfg.path("silver", "pos")).collect()
    assert sorted((r.processing_date, r.transaction_id) for r in rows) == [(DAYS[0], "A"), (DAYS[1], "B")]


def test_files_of_a_failed_day_stay(spark, tmp_path):
    raw, kept, base = tmp_path / "raw", tmp_path / "old", str(tmp_path / "lake")
    sale(raw, f"{DAYS[0]}_sales.csv", DAYS[0], "A")
    (raw / f"{DAYS[1]}_sales.csv").write_text("transaction_id,store_id\nT,1\n")
    for n, day in enumerate(DAYS[:2]):
        cfg = RunConfig(base, day, day, f"r{n}")
        if n == 0:
            run_landed(spark, POS, str(raw), cfg, str(kept))
        else:
            with pytest.raises(MissingColumns):
                run_landed(spark, POS, str(raw), cfg, str(kept))
    assert below(raw) == [f"{DAYS[1]}_sales.csv"] and below(kept) == [f"pos/{DAYS[0]}_sales.csv"]


def test_files_that_cannot_be_moved_are_told(spark, tmp_path):
    sale(tmp_path / "raw", "2025-07-20_a.csv", DAYS[0], "A")
    files = [f"file:{tmp_path}/raw/2025-07-20_a.csv", f"file:{tmp_path}/raw/gone.csv"]
    left = landing.move_to_archive(spark, files, str(tmp_path / "raw"), f"file:{tmp_path}/old/pos")
    assert left == files[1:] and below(tmp_path / "old") == ["pos/2025-07-20_a.csv"]


def test_an_archive_in_the_landing_folder_is_refused(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    cfg = RunConfig(str(tmp_path / "lake"), DAYS[0], DAYS[0], "r")
    with pytest.raises(ValueError, match="lies in the landing folder"):
        run_landed(spark, POS, f"{tmp_path}/raw/", cfg, f"{tmp_path}/raw/old")
