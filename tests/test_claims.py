"""Days that several runs want at the same time."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pytest

from shelfline.cli import run
from shelfline.config import RunConfig
from shelfline.model import INVENTORY, POS, SALES_KPI
from shelfline.plans import kpi
from shelfline.plans.batch import log_status, run_batch
from shelfline.plans.claims import claim_days
from shelfline.sources.raw import scan_inventory_raw, scan_pos_raw
from tests.test_jobs import DAYS, write_raw


def test_each_day_goes_to_one_run(spark, tmp_path):
    days = [date(2025, 7, 1) + timedelta(n) for n in range(20)]
    gate = threading.Barrier(8)

    def want(n):
        gate.wait()
        return claim_days(spark, str(tmp_path), "kpi", days, f"r{n}")

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(want, range(8)))
    assert sorted(d for part in got for d in part) == days
    holder = {d: f"r{n}" for n, part in enumerate(got) for d in part}
    for day in days:
        assert (tmp_path / f"runs/claims/kpi/{day}/0").read_text() == holder[day]
    # Another job's claims are its own.
    assert claim_days(spark, str(tmp_path), "other", days[:2], "r9") == days[:2]


def test_days_of_a_silent_run_are_free_after_a_time(spark, tmp_path):
    days, base = [date(2025, 7, 1), date(2025, 7, 2)], str(tmp_path)
    assert claim_days(spark, base, "kpi", days, "r1") == days
    old = (tmp_path / "runs/claims/kpi/2025-07-01/0").stat().st_mtime - 25 * 3600
    os.utime(tmp_path / "runs/claims/kpi/2025-07-01/0", (old, old))
    assert claim_days(spark, base, "kpi", days, "r2", hours=26) == []
    assert claim_days(spark, base, "kpi", days, "r2") == days[:1]
    assert claim_days(spark, base, "kpi", days, "r3") == []
    assert (tmp_path / "runs/claims/kpi/2025-07-01/1").read_text() == "r2"


def test_two_gates_compute_each_day_once(spark, tmp_path, monkeypatch):
    """Both see the same days as ready before either has begun."""
    write_raw(tmp_path / "raw")
    base = str(tmp_path / "lake")
    cfg = RunConfig(base, DAYS[0], DAYS[1], "r1")
    run_batch(spark, scan_pos_raw(spark, str(tmp_path / "raw/pos")), POS, cfg)
    run_batch(spark, scan_inventory_raw(spark, str(tmp_path / "raw/inventory")), INVENTORY, cfg)
    gate = threading.Barrier(2)

    def after_both(*args):
        assert args[3] == DAYS[:2]
        gate.wait()
        return claim_days(*args)

    monkeypatch.setattr(kpi, "claim_days", after_both)
    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(run, spark, ["kpi", "--base", base, "--run-id", f"k{n}"]) for n in range(2)]
        done = [job.result() for job in jobs]
    seen = sorted(r.processing_date for outcome in done if outcome is not None for r in outcome.collect())
    assert seen == DAYS[:2]
    log = spark.read.parquet(f"{base}/runs/log").filter("step = 'kpi_job'").collect()
    assert sorted(r.processing_date for r in log) == DAYS[:2]
    sales = spark.read.parquet(f"{base}/kpi/{SALES_KPI}").groupBy("processing_date").count().collect()
    assert sorted((r[0], r[1]) for r in sales) == [(d, 1) for d in DAYS[:2]]


def test_a_failed_range_keeps_no_other_from_running(spark, tmp_path, monkeypatch):
    days, base = [date(2025, 7, 1), date(2025, 7, 5)], str(tmp_path)
    for step in ("pos_transform", "inventory_transform"):
        for day in days:
            log_status(spark, RunConfig(base, day, day, "r1"), step, "COMPLETED")
    ran = []

    def one(spark, cfg):
        ran.append((cfg.start, cfg.end))
        if cfg.start == days[0]:
            raise RuntimeError("first")

    monkeypatch.setattr(kpi, "run_kpis", one)
    with pytest.raises(RuntimeError, match="first"):
        kpi.run_ready(spark, base, "k1")
    assert ran == [(d, d) for d in days]
    assert kpi.ready_days(spark, base) == days and kpi.run_ready(spark, base, "k2") == []
