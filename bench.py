"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder of the tables      (default /root/testdata/sf0.1)
BENCH_CPUS     cores of the local master (default 8)
BENCH_ROUNDS   timed rounds per query, the median counts (default 3)

A time covers building the plan, optimizing it and computing every row and
column of the result. Two untimed rounds per query warm the JVM up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from showcase.queries import QUERIES  # noqa: E402
from tallyboard.session import local_session  # noqa: E402

HEADLINES = (
    "scoreboard",
    "scoreboard_customers",
    "scoreboard_sum",
    "events_cutoff",
    "multi_report",
    "warnings",
    "run_metrics",
    "backfill_weeks",
    "backfill_events",
    "backfill_reports",
    "extract_clean",
    "retained_detail",
    "week_dimension",
    "display_rows",
    "kpi_cards",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINES:
        for _ in range(2):
            seconds(name)
        rounds = [seconds(name) for _ in range(int(os.environ.get("BENCH_ROUNDS", "3")))]
        times[name] = round(statistics.median(rounds), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total median time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
