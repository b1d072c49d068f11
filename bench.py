"""Time the headline queries and print one JSON line.

Each time covers building the plan, intermediate writes, and computing every row.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from plantpulse.queries import all_queries  # noqa: E402

HEADLINE = [
    "alarm_edges", "alarm_consolidated", "alarm_lines", "alarm_lines_strict", "alarm_zero_pruned",
    "join_lateral_next3", "win_locf_count", "state_carry_forward", "state_timeline", "batch_state_rollup",
    "recipe_periods", "state_durations", "alarm_count_time", "box_production", "batch_overview",
    "weight_hourly", "weight_batch_summary", "metrology_batch", "agg_histogram", "agg_pooled_stddev",
    "agg_gapfill_locf", "metric_per_period_wide", "join_asof_first_last", "screen_unsafe_text",
    "agg_global", "agg_approx_rows",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plantpulse-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="plantpulse-bench-"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark, known = session(), all_queries()
    wanted = sys.argv[1:] or HEADLINE

    def run(key: str) -> float:
        start = time.perf_counter()
        known[key](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # The first job pays for starting the engine, not for the query.
    run("alarm_edges")
    times = {key: round(run(key), 3) for key in wanted}
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
