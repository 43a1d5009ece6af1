"""Jobs from the command line, for spark-submit.

    run_job.py pos       --raw DIR --base DIR [--start D --end D | --processing-date D] [--archive DIR]
    run_job.py inventory --raw DIR --base DIR [...]
    run_job.py kpi       --base DIR [...]        (without days: all that are ready and not claimed)
    run_job.py load      --table T --manifest FILE --root DIR --jsonpaths FILE --base DIR
    run_job.py normalize --raw DIR --out DIR [--target-prefix P] [--processing-date D]
    run_job.py feed      --kind crm|web-logs --raw DIR --out DIR --checkpoint DIR
    run_job.py hook      --raw DIR --out DIR --checkpoint DIR
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from shelfline.config import RunConfig, new_run_id
from shelfline.model import FEEDS
from shelfline.operators.objects import INVENTORY_LANDING
from shelfline.plans.batch import run_landed
from shelfline.plans.kpi import raise_on_partial_failure, run_kpis, run_ready
from shelfline.plans.load import TABLES, load_stream
from shelfline.session import prepare
from shelfline.sources.json_files import normalize_json_files, write_json_lines
from shelfline.streaming.feeds import CLEANERS, run_feed, run_hook


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="run_job.py")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        one = jobs.add_parser(name)
        for path in paths:
            one.add_argument(f"--{path}", required=True)
        return one

    for name, paths in (
        ("pos", ["raw", "base"]), ("inventory", ["raw", "base"]), ("kpi", ["base"])
    ):
        one = job(name, *paths)
        one.add_argument("--processing-date")
        one.add_argument("--start")
        one.add_argument("--end")
        one.add_argument("--run-id")
        if name in FEEDS:
            one.add_argument("--archive", help="folder that files of stored days are moved to")
        if name == "kpi":
            one.add_argument(
                "--claim-hours", type=float, default=24, help="when a silent run's days are free again"
            )
    one = job("load", "manifest", "root", "jsonpaths", "base")
    one.add_argument("--table", required=True, choices=sorted(TABLES))
    one = job("normalize", "raw", "out")
    one.add_argument("--target-prefix", default=INVENTORY_LANDING)
    one.add_argument("--processing-date")
    one = job("feed", "raw", "out", "checkpoint")
    one.add_argument("--kind", required=True, choices=sorted(CLEANERS))
    one.add_argument("--max-files", type=int)
    one.add_argument("--archive", help="folder that processed files are moved to")
    job("hook", "raw", "out", "checkpoint").add_argument("--max-files", type=int)
    return top


def run(spark: SparkSession, argv: Sequence[str]) -> DataFrame | None:
    """Run one job. Batch jobs return their outcome per day."""
    args = parser().parse_args(argv)
    prepare(spark)
    if args.job == "feed":
        run_feed(
            spark, args.kind, args.raw, args.out, args.checkpoint,
            max_files=args.max_files, archive=args.archive,
        ).awaitTermination()
        return None
    if args.job == "hook":
        run_hook(spark, args.raw, args.out, args.checkpoint, args.max_files).awaitTermination()
        return None
    if args.job == "load":
        load_stream(spark, args.table, args.manifest, args.root, args.jsonpaths, args.base)
        return None
    if args.job == "normalize":
        files = normalize_json_files(spark, args.raw, args.target_prefix, args.processing_date)
        write_json_lines(files, f"{args.out.rstrip('/')}/{args.target_prefix.strip('/')}")
        bad = files.status.filter("status = 'FAILED'")
        number, some = bad.count(), [r.file for r in bad.orderBy("file").limit(20).collect()]
        files.close()
        if number:
            raise RuntimeError(f"{number} files that could not be read, among them: {some}")
        return None
    if args.job == "kpi" and not (args.processing_date or args.start):
        outcomes = run_ready(spark, args.base, args.run_id or new_run_id(), args.claim_hours)
        for outcome in outcomes:
            raise_on_partial_failure(outcome)
        return reduce(DataFrame.unionByName, outcomes) if outcomes else None
    cfg = RunConfig.of(args.base, args.processing_date, args.start, args.end, args.run_id)
    if args.job in FEEDS:
        return run_landed(spark, FEEDS[args.job], args.raw, cfg, args.archive)
    outcome = run_kpis(spark, cfg)
    raise_on_partial_failure(outcome)
    return outcome
