"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is timed cold (shared intermediates and the cache are cleared
before it) and fully executed with a ``noop`` write, so the time covers the
whole plan including the scalar jobs it needs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "monthly_risk_score",      # harm -> dense panel -> decay -> 25-cell kernel -> scaler
    "gridmonth_panel",         # densify + lags/rolling + 8-neighbour lag mean
    "hourly_grid",             # radius pairs + kernel weighted mean + power score
    "spearman_score_count",    # distributed average ranks
    "drift_profile",           # PSI of 21 features x 3 batches
    "baseline_comparison",     # 3 protocols x 4 baselines, one metrics pass
    "radius_pairs",            # grid-bucket range join
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from cellrisk.session import get_spark
    from cellrisk.plans.catalog import QUERIES, clear_memo

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    names = [n for n in HEADLINE if n in QUERIES]
    # warm the JVM once on the smallest data (not timed)
    QUERIES["bbox_predicate"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        clear_memo()
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
