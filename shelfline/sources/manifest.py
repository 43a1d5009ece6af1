"""Load exactly the files a manifest lists."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "entries array<struct<url: string, mandatory: boolean>>"


def plain_path(url: Column) -> Column:
    """One spelling for local URLs; other schemes stay as they are."""
    return F.regexp_replace(url, r"^file:/*", "/")


class ListedFile(NamedTuple):
    path: str
    mandatory: bool
    present: bool


def exist(spark: SparkSession, paths: Sequence[str], at_once: int = 32) -> list[bool]:
    """Whether each path exists, asked of its store one by one; no folder is listed."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()

    def there(path: str) -> bool:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(conf).exists(target)

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(there, paths))


def listed_files(spark: SparkSession, manifest: str, root: str) -> list[ListedFile]:
    """The manifest's files by path, and whether they are there, below ``root``.

    Only names reach the driver, as those of any file scan do. A path that is listed twice is
    one file, mandatory if one of its entries is.
    """
    entries = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(manifest).select(F.inline("entries"))
    wanted = (
        entries.groupBy(plain_path(F.col("url")).alias("path"))
        .agg(F.bool_or(F.coalesce("mandatory", F.lit(False))).alias("mandatory"))
        .orderBy("path")
        .collect()
    )
    top = re.sub(r"^file:/*", "/", root.rstrip("/")) + "/"
    below = [w.path.startswith(top) for w in wanted]
    found = iter(exist(spark, [w.path for w, inside in zip(wanted, below) if inside]))
    return [ListedFile(w.path, w.mandatory, inside and next(found)) for w, inside in zip(wanted, below)]


def scan_listed(spark: SparkSession, listed: Sequence[ListedFile]) -> DataFrame:
    """Lines of the files. A missing mandatory file fails, an optional one is skipped."""
    missing = [f.path for f in listed if f.mandatory and not f.present]
    if missing:
        raise FileNotFoundError(f"mandatory files missing: {missing}")
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", f.path) for f in listed if f.present]
    if not paths:
        return spark.createDataFrame([], "value string")
    return spark.read.text(paths).select("value")


def manifest_scan(spark: SparkSession, manifest: str, root: str) -> DataFrame:
    """Lines of the files that a manifest lists."""
    return scan_listed(spark, listed_files(spark, manifest, root))


def write_manifest(spark: SparkSession, folder: str, path: str) -> None:
    """List the files below ``folder`` with their sizes as a manifest, all of them mandatory.

    One row, as the manifest is one document: the names of a single batch's files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    entry = F.struct(
        plain_path(F.col("path")).alias("url"),
        F.lit(True).alias("mandatory"),
        F.struct(F.col("length").alias("content_length")).alias("meta"),
    )
    entries = F.array_sort(F.collect_list(entry)).alias("entries")
    files.agg(entries).write.mode("overwrite").json(path)
