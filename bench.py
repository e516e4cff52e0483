"""Time the headline queries; prints one JSON line.

Every query is planned and fully computed into the ``noop`` sink. One small
query runs first so that session start-up is not part of any time.
"""

from __future__ import annotations

import json
import os
import time

from screenmeld.plans import QUERIES
from screenmeld.session import local_session

HEADLINE = [
    "ecr_rerank", "ecr_weight_scenarios", "top_n_per_target", "ranking_metrics", "roc_pr_curves",
    "ks_statistic", "spearman_pairs", "kendall_pairs", "bootstrap_ci", "grid_metrics",
    "loo_results", "chunk_merge_last_wins", "coverage_gate", "completed_from_log",
    "pose_energies", "scorer_poses", "cascade_match", "endpoint_max_argmax",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("class_balance")
    times: dict[str, float] = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else None}))


if __name__ == "__main__":
    main()
