"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hearthscore.queries import QUERIES  # noqa: E402
from hearthscore.session import local_session  # noqa: E402

HEADLINE = [
    "preprocess_households",
    "cost_pivot",
    "dedup_first",
    "member_costs",
    "household_rollup",
    "audit_missing",
    "grain_report",
    "income_by_buyer",
    "cost_histogram",
    "correlation_matrix",
    "stratified_split",
    "build_matrix",
    "classification_scorecard",
    "lift_curve",
    "regression_scorecard",
    "residual_qq",
    "inertia",
    "silhouette",
    "action_table",
    "household_top_offer",
    "train_forest",
    "train_logistic",
    "train_ridge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for _ in range(2):  # lets the JVM compile the hot code; timed again below
        run(HEADLINE[0])
    times = {name: round(run(name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total wall-clock of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
