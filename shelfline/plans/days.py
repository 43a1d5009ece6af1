"""Runs over many days in which a bad day fails alone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from shelfline.config import RunConfig


class DaysFailed(RuntimeError):
    """Some days could not be run; the others are stored."""

    def __init__(self, failed: dict[date, Exception], outcome: DataFrame | None) -> None:
        self.failed, self.outcome = failed, outcome
        told = {str(day): str(error).splitlines()[0] for day, error in sorted(failed.items())}
        super().__init__(f"days that failed: {told}")


def _halved(
    run: Callable[[RunConfig], DataFrame], cfg: RunConfig, failed: dict[date, Exception]
) -> list[DataFrame]:
    try:
        return [run(cfg)]
    except (PySparkException, Py4JJavaError) as error:
        if cfg.start == cfg.end:
            failed[cfg.start] = error
            return []
    middle = cfg.start + (cfg.end - cfg.start) // 2
    later = next(day for day in cfg.days if day > middle)
    parts = (replace(cfg, end=middle), replace(cfg, start=later))
    return [done for part in parts for done in _halved(run, part, failed)]


def isolate_days(
    run: Callable[[RunConfig], DataFrame],
    cfg: RunConfig,
    note_failure: Callable[[RunConfig], None],
) -> DataFrame:
    """One run over all days. If Spark cannot run it, its halves, down to single days.

    A run replaces what it stored for its days, so a half repeats what the whole had begun.
    With b bad days of n that is about 2 b log2(n) further runs, and none if all is well.
    Failed days are noted and then raised; any other error is noted for all days of the run.
    """
    failed: dict[date, Exception] = {}
    try:
        outcomes = _halved(run, cfg, failed)
    except Exception:
        note_failure(cfg)
        raise
    outcome = reduce(DataFrame.unionByName, outcomes) if outcomes else None
    for day in sorted(failed):
        note_failure(replace(cfg, start=day, end=day))
    if failed:
        raise DaysFailed(failed, outcome) from next(iter(failed.values()))
    return outcome
