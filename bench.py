"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times (2); the median counts. Results
go to the no-op sink, so every row is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from suite import registry  # noqa: E402
from vacancia.session import local_session  # noqa: E402

HEADLINE = [
    "silver_job_detail", "mart_salary_by_level", "mart_skill_demand_v2", "mart_skill_cooccurrence",
    "mart_company_hiring", "job_features", "classify_title", "upsert_newest_wins", "frontier_claim",
    "extract_skills_by_taxonomy", "html_to_text", "jobposting_topcv", "alert_match",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    os.environ.setdefault("SUITE_PARTITIONS", os.environ.get("BENCH_CPUS", "8"))  # its tables are single files
    registry.load()
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
