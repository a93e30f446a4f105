"""Benchmark: run the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each job is run to completion with the ``noop`` sink (every row computed, none
collected).  Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

BENCH_ALL=1 runs every registered job instead of the headline set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "frequent_flyers", "visit_gap", "gap_distribution_4", "gap_by_diagnosis", "care_episodes",
    "readmission_rate", "payer_mix", "revenue_by_diagnosis", "column_profile",
    "drop_duplicate_encounters", "cohort_retention", "predictive_risk", "diagnosis_pairs",
    "json_summary", "moving_avg_bill", "running_total", "cost_ntiles", "spend_cdf",
    "pareto_top1", "bill_zscore", "monthly_cumulative", "top_bills_per_diagnosis",
    "bill_audit", "referral_chain",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from admitlab.plans.registry import jobs
    from admitlab.session import get_spark

    spark = get_spark(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    registry = jobs()
    names = sorted(registry) if os.environ.get("BENCH_ALL") else [n for n in HEADLINE if n in registry]

    # warm-up (JVM start, code generation caches); not timed
    registry["readmission_rate"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
