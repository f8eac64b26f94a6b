"""Headline queries at one scale factor; prints one JSON line.

BENCH_SF_DIR names the tables' folder, BENCH_CPUS the local cores, BENCH_RUNS
the timed runs after one warm-up run. A query's time is the median of its
runs, whole result, jobs started while building it included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from outpulse.catalog import QUERIES  # noqa: E402
from outpulse.session import local_session  # noqa: E402

HEADLINE = (
    "chart_referrers",
    "topk_referrers",
    "topk_per_tenant",
    "append_new_rows",
    "agg_daily_traffic",
    "agg_trailing_totals",
    "join_daily_series",
    "win_sessions",
    "ga_overview",
    "ga_report_generic",
    "ga_top_pages",
    "ga_top_sources",
    "digest_ga",
    "filt_exclude",
    "join_exclude_anti",
    "dedupe_by_url",
    "win_rank_in_source",
    "agg_keyword_source",
    "collect_mentions",
    "digest_mentions",
    "win_topn_per_keyword",
    "join_unseen",
    "opportunities",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(
        cpus, "outpulse-bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    took = {}
    for name in names:
        timed(name)
        took[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
        print(f"{name:24s} {took[name]:7.3f}s", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {"metric": "sum of median query times", "value": round(sum(took.values()), 3), "unit": "sec",
             "queries": took, "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}
        )
    )


if __name__ == "__main__":
    main()
