"""Write PLANS.md: physical plans of representative jobs.

usage: python tools/plans.py [sf_dir]

Plans are printed with adaptive execution off, i.e. as planned before any
runtime statistics; at run time AQE may still turn a join into a broadcast,
coalesce partitions or split skewed ones.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from admitlab.plans import intervals  # noqa: E402
from admitlab.plans.registry import jobs  # noqa: E402
from admitlab.session import get_spark  # noqa: E402
from admitlab.sources.tables import encounters, save_encounters  # noqa: E402

SHOW = [
    ("frequent_flyers", "flagship: one exchange on patient_key, partial aggregate, per-task top-k"),
    ("cost_ntiles", "global NTILE without a single-partition window: exchange by value range"),
    ("moving_avg_bill", "global ROWS frame: ranges, then blocks with a halo"),
    ("top_bills_per_diagnosis", "top-k per group with WindowGroupLimit before the exchange"),
    ("drop_duplicate_encounters", "lowest id per group: partial aggregate + semi join"),
    ("diagnosis_pairs", "pairs after collapsing to (patient, diagnosis, n)"),
    ("patient_lookup", "key predicate pushed into both Parquet scans"),
    ("executive_dashboard", "two-level aggregate, no join"),
]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 8, extra={"spark.sql.adaptive.enabled": "false"})
    out = ["# PLANS", "", f"Physical plans on `{sf_dir}` (`local[8]`, 8 shuffle partitions, AQE off so",
           "the plan is shown as planned; at run time AQE may broadcast, coalesce or split).",
           "Generated by `python tools/plans.py`.", ""]
    reg = jobs()
    for key, why in SHOW:
        plan = reg[key](spark, sf_dir)._jdf.queryExecution().executedPlan().treeString()
        out += [f"## {key}", "", why, "", "```", plan.rstrip(), "```", ""]
    stored = save_encounters(encounters(spark, sf_dir), "encounters_by_patient", 8)
    plan = intervals.frequent_flyers(stored)._jdf.queryExecution().executedPlan().treeString()
    out += ["## frequent_flyers on the bucketed layout", "",
            "`save_encounters` (bucketed by patient_key): no exchange at all.", "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
