"""Time headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores. Stage
builds are timed as queries of their own, so later queries show what they add.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from remitlens.plans import catalog  # noqa: E402
from remitlens.plans.stages import open_stages  # noqa: E402
from remitlens.session import build_session  # noqa: E402

HEADLINE = [
    "recovery_by_state", "expected_payment", "state_benchmark", "match_rate", "join_audit",
    "stage:claims", "variance_summary", "missing_detect", "describe_exact", "outlier_comparison",
    "stage:flagged", "before_after", "duplicate_flag",
    "stage:modeling", "context_features", "leakage_audit", "corr_matrix", "skew_report",
    "stage:queue", "queue_top", "queue_summary", "queue_view", "rollup_code", "rollup_all", "executive_summary",
    "box_by_place", "median_by_locality", "pr_curve", "threshold_table", "formula_baseline", "target_encoding",
    "random_sample", "patterns", "isolation_forest",
]


def run(spark, sf_dir: str, name: str) -> None:
    if name.startswith("stage:"):
        getattr(open_stages(spark, sf_dir), name.split(":")[1])
        return
    catalog.all_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("remitlens-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before timing
    only = sys.argv[1:]
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        start = time.perf_counter()
        run(spark, sf_dir, name)
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(Path(sf_dir).name.removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
