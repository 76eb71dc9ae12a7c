"""Times the headline queries and prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""
from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from panelflume.registry import QUERIES

HEADLINE = [
    "a07_panel_scan", "a07_panel_scan_nation_brand", "c00_calendar_frame", "e14_feature_frame", "h02_grid_search",
    "h06_adf", "i04_hybrid_forecast", "i06_walk_forward_cv", "i08_bootstrap_interval", "i09_permutation_importance",
    "j02_did_att", "j07_many_experiments", "j14_elasticity_table", "j14_elasticity_many_routes",
    "k06_allocation_record", "k07_sensitivity_sweep", "k08_route_allocation", "l02_scorecard",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("panelflume-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="panelflume-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["j02_did_att"].run(spark, sf_dir).collect()  # start-up is not part of any query
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
