"""Times the headline queries and prints one JSON line.

Reads the tables in $BENCH_SF_DIR on local[$BENCH_CPUS]. Each query is run once to warm
up and then twice; the better run counts. A run builds the query and writes its whole
result to Spark's no-op sink. The stream is run once, marts written to disk.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.catalog import QUERIES  # noqa: E402
from martkeep.session import build_session  # noqa: E402

HEADLINE = (
    "cdc_parse",
    "touched_keys",
    "route_fallthrough",
    "progress_rows",
    "progress_rows_one_per_key",
    "progress_rows_with_tombstones",
    "enroll_rows",
    "tombstones",
    "last_learning",
    "insert_date_revival",
    "merge_progress",
    "merge_enroll",
    "rebuild_progress",
    "reconcile_progress",
)
ONCE = ("stream_progress",)


def timed(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, sf_dir)
        seconds[name] = round(min(timed(spark, name, sf_dir) for _ in range(2)), 3)
    for name in ONCE:
        seconds[name] = round(timed(spark, name, sf_dir), 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
