"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the given tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfline.queries import QUERIES  # noqa: E402
from shelfline.session import local_session  # noqa: E402

HEADLINE = [
    "pos_valid",
    "pos_text_invalid",
    "pos_validation_summary",
    "pos_dedup",
    "inventory_dedup",
    "lineitem_dedup",
    "inventory_bucket_agg",
    "pos_bucket_agg",
    "bucket_join",
    "failed_joins",
    "sales_kpis",
    "inventory_kpis",
    "regional_kpis",
    "regional_kpis_exact",
    "processing_metrics",
    "clean_weblog",
    "route_invalid",
    "sanitize_crm",
    "transform_records",
    "jsonpath_weblogs",
    "status_upsert",
    "path_metadata",
    "land_csv",
    "scan_pos_raw",
    "normalize_json_files",
    "silver_roundtrip",
    "replace_by_date",
    "backfill_status",
    "stream_crm",
    "stream_bucket_agg",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    # Start-up of the JVM's code generation is not part of any query.
    seconds(spark, "pos_valid", sf_dir)
    timings = {name: seconds(spark, name, sf_dir) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
