"""Claims of days: of several runs of a job that want a day, one gets it."""

from __future__ import annotations

import time
from collections.abc import Iterable
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class _Store:
    """The few calls on the tables' file system that a claim needs."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path_of = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.files = self.path_of(path).getFileSystem(conf)

    def ages(self, folder: str) -> list[float]:
        """Seconds since each file of the folder was made; none where it does not exist."""
        where = self.path_of(folder)
        if not self.files.exists(where):
            return []
        now = time.time()
        return [now - f.getModificationTime() / 1000 for f in self.files.listStatus(where)]

    def create(self, path: str, text: str) -> bool:
        """Make a file that must not exist yet; of several that try, one succeeds."""
        target = self.path_of(path)
        self.files.mkdirs(target.getParent())
        if self.files.getScheme() == "file":
            # Hadoop's local file system looks first and creates then.
            try:
                with open(self.files.makeQualified(target).toUri().getPath(), "x") as file:
                    file.write(text)
            except FileExistsError:
                return False
            return True
        try:
            out = self.files.create(target, False)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        out.write(text.encode())
        out.close()
        return True


def claim_days(
    spark: SparkSession, base: str, job: str, days: Iterable[date], run_id: str, hours: float = 24
) -> list[date]:
    """Those of ``days`` that this run may compute; no other run gets them.

    A claim is a file ``runs/claims/<job>/<day>/<attempt>`` that holds the run's id, created
    only if it does not exist, as HDFS and local disks can tell. It is never taken back: a
    finished or failed day is in the log and is not asked for again. A run that died without
    a word loses its days after ``hours``, by a file for the next attempt, which again one
    run can create. Choose ``hours`` longer than a run takes.
    """
    own = f"{base.rstrip('/')}/runs/claims/{job}"
    store = _Store(spark, own)
    got = []
    for day in days:
        ages = store.ages(f"{own}/{day}")
        if ages and min(ages) < hours * 3600:
            continue
        if store.create(f"{own}/{day}/{len(ages)}", run_id):
            got.append(day)
    return got
