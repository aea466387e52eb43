"""Headline queries at one scale; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from agorakit.plans.catalog import queries  # noqa: E402
from agorakit.session import local_session  # noqa: E402

HEADLINE = (
    "u12_unified_users", "e6_activity_events", "c1_user_cohorts", "d5_daily_metrics", "m5_monthly_metrics", "r3_cohort_retention",
    "k1_post_metrics", "v1_engagement_levels", "f2_engagement_training", "n1_worked_together", "n2_studied_together",
    "n3_company_networks", "l1_connection_recommendations", "l2_company_network_map", "l5_location_based_networks",
    "l6_alumni_networks", "v3_top_connected", "h1_inbox", "h4_unread_total", "q6_hubs",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cores, shuffle_partitions=cores)
    catalog = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("q2_relationship_counts")
    run("u12_unified_users")
    timings = {}
    for name in wanted:
        times = sorted(run(name) for _ in range(repeats))
        timings[name] = round(times[len(times) // 2], 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    total = round(sum(timings.values()), 3)
    line = {"metric": "headline_total_seconds", "value": total, "unit": "sec", "queries": timings, "sf": os.path.basename(folder.rstrip("/"))}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
