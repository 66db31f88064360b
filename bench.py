"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once untimed on the smallest tables, so that the figures leave out class loading and code
generation, then once timed from building the plan to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINES = [
    "profile_column_types",
    "profile_dataset_overview",
    "profile_numeric_summary",
    "profile_column_overview",
    "clean_flag_duplicates",
    "parse_nested",
    "behavior_thresholds",
    "feature_model_table",
    "split_by_time",
    "split_by_time_ties",
    "mining_many_categories",
    "mining_many_bins",
    "mining_business_segments",
    "mining_flag_combinations",
    "mining_category_pairs",
    "stability_compare_bins",
    "eval_curve_areas",
    "eval_threshold_search",
    "policy_review_capacity",
    "error_numeric_summary",
    "score_and_decide",
]


def main() -> None:
    from riskloom.catalog import registry
    from riskloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, name="bench")
    queries, seconds = registry.queries(), {}
    for name in sys.argv[1:] or HEADLINES:
        if os.path.isdir(small):
            queries[name](spark, small).write.format("noop").mode("overwrite").save()
        started = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
