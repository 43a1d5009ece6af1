"""Which files of a landing folder a run takes, known before any of them is opened."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.config import RunConfig
from shelfline.model import Feed
from shelfline.sources.raw import FILE_DATE, PARTITION_DATE, file_day, scan_inventory_raw, scan_pos_raw, with_file_date

LEDGER = "file string, modified timestamp, day date, source_type string, job_run_id string"
GLOBS = {"pos": "*.[cC][sS][vV]", "inventory": "*"}


def listed_day(path: Column) -> Column:
    """The day of a file by its ``partition_date`` folder, else by its name; NULL if neither."""
    folder = F.regexp_extract(path, rf"/{PARTITION_DATE}=(\d{{4}}-\d{{2}}-\d{{2}})/", 1)
    return F.coalesce(F.when(folder != "", folder).try_cast("date"), file_day(path))


def landed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file, modified, day) of all files below ``path``, from their listing alone."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .filter(F.col("length") > 0)
    )
    return listed.select(
        F.col("path").alias("file"), F.col("modificationTime").alias("modified"), listed_day(F.col("path")).alias("day")
    )


def ledger(spark: SparkSession, base: str) -> DataFrame:
    """Files taken by finished runs."""
    path = f"{base.rstrip('/')}/runs/files"
    try:
        return spark.read.schema(LEDGER).parquet(path).drop("first_day")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def files_to_take(
    spark: SparkSession, feed: Feed, landing: str, cfg: RunConfig, archive: str | None = None
) -> DataFrame:
    """Files of the run's days, and those of no day that no other run has taken.

    A day is always taken whole, as a run replaces its days; so running a day again gives the
    same rows. With an ``archive``, the days' files that earlier runs moved there belong to
    them too, but one that came again under its name replaces the archived one. A file of no
    day only goes to quarantine, and that once, unless it changed; it stays where it is.
    """
    found = landed_files(spark, landing, GLOBS[feed.name])
    others = ledger(spark, cfg.base).filter(
        (F.col("source_type") == feed.name) & (F.col("job_run_id") != cfg.run_id)
    )
    new = found.filter(F.col("day").isNull()).join(others, ["file", "modified"], "left_anti")
    of_run = F.col("day").between(F.lit(cfg.start), F.lit(cfg.end))
    dated = found.filter(of_run)
    if archive:
        kept = archive_of(spark, feed, landing, archive)
        here = dated.select(_below("file", qualified(spark, landing)).alias("name"))
        moved = _archived(spark, kept).filter(of_run).withColumn("name", _below("file", kept))
        dated = dated.unionByName(moved.join(here, "name", "left_anti").drop("name"))
    return dated.unionByName(new)


def qualified(spark: SparkSession, path: str) -> str:
    """A folder's name as listings begin with it."""
    target, store = _located(spark, path)
    return store.makeQualified(target).toString().rstrip("/")


def archive_of(spark: SparkSession, feed: Feed, landing: str, archive: str) -> str:
    """The feed's folder of the archive, which must lie outside of the landing folder."""
    own = f"{qualified(spark, archive)}/{feed.name}"
    if f"{own}/".startswith(f"{qualified(spark, landing)}/"):
        raise ValueError(f"the archive {archive} lies in the landing folder {landing}")
    return own


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _below(file: str, root: str) -> Column:
    return F.substr(F.col(file), F.lit(len(root) + 2))


def _archived(spark: SparkSession, kept: str) -> DataFrame:
    target, store = _located(spark, kept)
    if store.exists(target):
        return landed_files(spark, kept)
    return spark.createDataFrame([], "file string, modified timestamp, day date")


def move_to_archive(spark: SparkSession, files: list[str], landing: str, kept: str) -> list[str]:
    """Move files from the landing folder to ``kept``, below which they keep their paths.

    Returns those that could not be moved. They do no harm: a run of their day takes them
    where they are. An archived file of the same name is replaced.
    """
    root = qualified(spark, landing)

    def move(file: str) -> bool:
        source, store = _located(spark, file)
        target, _ = _located(spark, kept + file[len(root) :])
        try:
            store.mkdirs(target.getParent())
            store.delete(target, False)
            return store.rename(source, target)
        except Py4JJavaError:
            return False

    # Calls that wait for the store, none of which moves data through the driver.
    with ThreadPoolExecutor(16) as pool:
        return [file for file, moved in zip(files, pool.map(move, files)) if not moved]


def as_path(file: Column) -> Column:
    """A file's name as a path to read, where marks of patterns stand for themselves."""
    return F.regexp_replace(file, r"([\[\]{}*?\\])", r"\\$1")


def scan_files(spark: SparkSession, feed: Feed, landing: str, files: list[str]) -> DataFrame:
    """The raw rows of the given files with the day of each. Only these are opened, also to
    find the fields of JSON.

    Files are read by the keys of their folders: one scan over some with and some without
    ``key=value`` folders would pass the latter over.
    """
    if not files:
        names = ", ".join(f"`{c}` string" for c in feed.columns)
        return spark.createDataFrame([], f"{names}, {FILE_DATE} date")
    by_keys: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        by_keys.setdefault(tuple(re.findall(r"/([^/=]+)=[^/]*(?=/)", file)), []).append(file)
    scans = [_scan(spark, feed, landing, some) for some in by_keys.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _scan(spark: SparkSession, feed: Feed, landing: str, files: list[str]) -> DataFrame:
    if feed.name == "pos":
        return with_file_date(scan_pos_raw(spark, landing, files))
    return with_file_date(scan_inventory_raw(spark, landing, infer=True, files=files))


def remember(taken: DataFrame, feed: Feed, cfg: RunConfig) -> None:
    """Add the files of a finished run to the ledger, in place of what the same run had for the
    range that begins with its first day."""
    own = f"job_run_id={cfg.run_id}/first_day={cfg.start}"
    path = cfg.path("runs", "files", f"source_type={feed.name}", own)
    taken.coalesce(1).write.mode("overwrite").parquet(path)

