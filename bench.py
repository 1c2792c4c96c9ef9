"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names instead of the headline set
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from farol.queries.catalog import QUERIES  # noqa: E402

HEADLINE = ("flagship_triage", "h2_sweep", "h3_tune", "h6_report", "v9_roc_auc", "v10_average_precision", "v12_metrics_table",
            "v14_roc_points", "v18_calibration", "q_audit", "d1_describe", "c1_pearson", "c1_pearson_wide", "c2_spearman", "e1_density_histogram",
            "e3_box_table", "t1_split", "t4_folds", "p2_standard_scale", "p7_one_hot", "p9_fit_on_train", "m1_logistic", "m2_tree", "m3_neighbours",
            "m4_forest", "m5_boosting", "m10_grid_search", "i4_permutation_importance", "i5_shapley_linear", "i7_linear_shapley")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("farol-bench").config("spark.sql.shuffle.partitions", cpus)
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
