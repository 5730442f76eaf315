"""Headline timings: prints one JSON line.

Each query runs once untimed (class loading, code generation, file listing) and is then timed to the last row, written
to the no-op sink so that nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "indicator_summary",
    "spatial_count",
    "spatial_density",
    "within_holes",
    "intersects_polygons",
    "within_distance_pairs",
    "flag_share",
    "clip_length",
    "nearest_distance",
    "nearest_feature",
    "preagg_spatial",
    "pct_null_safe",
    "sector_share",
    "pivot_rates",
    "minmax_scale",
    "distinct_on",
    "project_lcc",
    "semi_join",
    "year_roll",
    "survey_build",
    "survey_files",
    "change_by_area",
    "legend_breaks_by_table",
    "json_publish",
    "metadata_report",
]


def main() -> None:
    from areastats.registered import QUERIES
    from areastats.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        f"local[{cpus}]",
        "areastats-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
