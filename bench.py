"""Bench: time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["missing_profile", "target_correlation", "linear_features", "grid_search",
            "gbt_categorical", "permutation_importance_linear", "error_audit", "ensemble_predict",
            "blend_search", "elasticnet_cv"]


def sized(spark, sf_dir):
    """Headline queries that run at a size of their own here."""
    from hearth.plans.q_trees import _run
    return {"gbt_categorical": lambda: _run(spark, sf_dir, "GBT_Categorical", {"rounds": [20], "rate": [0.1], "max_depth": [4]})}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from hearth.plans.catalog import QUERIES
    from hearth.session import get_session

    from hearth.plans.frames import listing_frame

    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # stage/task times without the UI
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, extra=extra)
    t0 = time.time()
    listing_frame(spark, sf_dir)  # the listing table is built and written once per run
    times = {"materialize_listing": round(time.time() - t0, 3)}
    own = sized(spark, sf_dir)
    for name in names:
        t0 = time.time()
        df = own[name]() if name in own else QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": int(cpus)}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
