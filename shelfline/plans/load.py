"""Load delivered records into the stream tables: a manifest, a JSONPaths file, a table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from shelfline.functions.payload import CRM_FLAT, WEBLOG_FLAT, Target, jsonpath_project
from shelfline.session import prepare
from shelfline.sources.manifest import listed_files, scan_listed
from shelfline.sources.responses import with_payload

LOADED = "manifest"
# Per table: its columns with their types and widths, in the order of the JSONPaths file.
TABLES: dict[str, list[Target]] = {
    "web_logs_stream": WEBLOG_FLAT,
    "customer_interaction_stream": CRM_FLAT,
}


def read_jsonpaths(spark: SparkSession, path: str) -> list[str]:
    """The paths of a JSONPaths file, which has one per column of a table."""
    schema = "jsonpaths array<string>"
    return list(spark.read.schema(schema).option("multiLine", True).json(path).first().jsonpaths)


def with_paths(columns: Sequence[Target], paths: Sequence[str]) -> list[Target]:
    """Columns and paths belong together by their order."""
    if len(columns) != len(paths):
        raise ValueError(f"{len(paths)} paths for {len(columns)} columns")
    return [replace(c, path=p) for c, p in zip(columns, paths)]


def manifest_digest(entries: Sequence[tuple[str, bool]]) -> str:
    """Tells manifests apart by what they list, in any order."""
    return hashlib.sha256(json.dumps(sorted(entries)).encode()).hexdigest()


def load_stream(
    spark: SparkSession, table: str, manifest: str, root: str, jsonpaths: str, base: str
) -> DataFrame:
    """Add the records of the manifest's files to a stream table and return the table.

    Rows lie in a folder by what the manifest lists. Loading it again, after a failure or by
    mistake, replaces that folder: every manifest counts once.
    """
    columns = with_paths(TABLES[table], read_jsonpaths(prepare(spark), jsonpaths))
    listed = listed_files(spark, manifest, root)
    rows = jsonpath_project(with_payload(scan_listed(spark, listed)), columns)
    path = f"{base.rstrip('/')}/stream/{table}"
    own = manifest_digest([(f.path, f.mandatory) for f in listed])
    rows.write.mode("overwrite").parquet(f"{path}/{LOADED}={own}")
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
