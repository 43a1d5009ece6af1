"""Run settings, and the folder shared by driver and executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


@dataclass(frozen=True)
class RunConfig:
    """One run: where tables live, which days it covers, and its id."""

    base: str
    start: date
    end: date
    run_id: str = field(default_factory=new_run_id)

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"start {self.start} is after end {self.end}")

    def path(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    @property
    def days(self) -> list[date]:
        return [self.start + timedelta(n) for n in range((self.end - self.start).days + 1)]

    @classmethod
    def of(
        cls,
        base: str,
        processing_date: str | None = None,
        start: str | None = None,
        end: str | None = None,
        run_id: str | None = None,
    ) -> RunConfig:
        """A range if both ends are given, else the single day, else today in UTC."""
        if start and end:
            lo, hi = date.fromisoformat(start), date.fromisoformat(end)
        else:
            day = processing_date or datetime.now(timezone.utc).date().isoformat()
            lo = hi = date.fromisoformat(day)
        return cls(base, lo, hi, run_id or new_run_id())


_to_clear: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for cut lineage.

    Where none is named, a session in a single process gets a scratch folder; any other
    must name one, as executors would write to disks that no one else sees.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="shelfline-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses; it goes when the driver ends."""
    own = f"{shared_dir(spark)}/shelfline/{spark.sparkContext.applicationId}"
    if own not in _to_clear:
        _to_clear.add(own)
        atexit.register(delete, spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store Spark can write to, if the session still runs."""
    if spark.sparkContext._jsc is None:
        return
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    target.getFileSystem(conf).delete(target, True)


def stage(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to ``path``, in folders by the given columns, and read it back.

    Cuts the lineage with something that outlives a lost executor, so that several outputs
    can be taken from one computation.
    """
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Give back the space of a staged table."""
    delete(spark, path)


@contextmanager
def staged(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> Iterator[DataFrame]:
    """A staged table in the shared folder, for as long as the block runs."""
    spark = df.sparkSession
    path = new_shared_path(spark, name)
    try:
        yield stage(df, path, by)
    finally:
        release(spark, path)
