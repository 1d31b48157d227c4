"""Time the headline queries; prints one JSON line (and each time on stderr as it is known).

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS].
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskframe.queries import all_queries
from riskframe.session import local_session

HEADLINE = (
    "cln3_fill_median_mode",
    "cln5_forward_fill",
    "cln7_keep_first",
    "scl2_time_features",
    "jon1_ip_range_join",
    "jon2_ip_asof_join",
    "win1_velocity",
    "win2_velocity_before",
    "win3_user_gaps",
    "agg1_device_risk",
    "agg7_correlations",
    "agg9_describe_bank",
    "agg12_histogram_by_label",
    "agg16_country_levels",
    "rsk5_summary",
    "sta1_mann_whitney_bank",
    "enc1_label_codes",
    "enc3_onehot_all",
    "sca1_standard",
    "spl1_stratified_bank",
    "res1_smote_transactions",
    "res2_undersample",
    "met1_evaluate_all",
    "mod1_logistic_regression",
    "mod2_random_forest",
    "mod7_fold_summary",
    "exp2_linear_phi_transactions",
    "exp3_tree_phi",
    "exp10_case_contributions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    known = all_queries()
    known["agg1_device_risk"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
