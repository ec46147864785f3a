"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. The smallest tables next to
them are run through once before the clock starts, so that the times are those of a running session.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from rooftally.fixtures import table  # noqa: E402
from rooftally.plans.build import process_layer  # noqa: E402
from rooftally.queries import QUERIES  # noqa: E402
from rooftally.queries.plans import numbered  # noqa: E402
from rooftally.session import build_session, stage  # noqa: E402

HEADLINE = [
    "boundary_stats", "boundary_assign", "dedup_geometry", "clean_report", "scan_bbox", "grid_index", "layer_bounds",
    "quadtree_chunks", "volumes", "spatial_slices", "export_rectangle", "clip_mask", "adaptive_cover", "pending_tiles",
    "cascade_match", "override_match", "queue_order", "continent_stats", "recent_events", "event_windows",
]


def run(spark, sf_dir: str) -> dict[str, float]:
    seconds = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    # the whole processing job, small chunks merged, as one layer: input rows against seconds
    rows = stage(numbered(spark, sf_dir).withColumn("source", F.lit("layer")))

    def whole_job() -> None:
        limits = {"target": 20_000, "minimum": 5_000, "maximum": 25_000}
        layer, report = process_layer(rows, dataset="source", height="height", **limits)
        layer.write.format("noop").mode("overwrite").save()
        report.write.format("noop").mode("overwrite").save()

    timed("process_layer", whole_job)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = Path(sf_dir).parent / "sf0.001"
    warm = small.is_dir() and str(small) != sf_dir
    if warm:
        run(spark, str(small))
    table(spark, sf_dir, "lineitem").count()
    seconds = run(spark, sf_dir)
    rows = table(spark, sf_dir, "lineitem").count()
    result = {
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"), "buildings": rows, "warm": warm,
        "process_layer_rows_per_sec": round(rows / seconds["process_layer"]),
        "boundary_stats_rows_per_sec": round(rows / seconds["boundary_stats"]),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
