"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the local cores. The two written inputs, the
raw telemetry derived from the test data and the output of stage 1, are made first, in a cold
session. ``stage1_write``, the product of stage 1, counts in the total; deriving the raw telemetry, which
no user does, is listed only. ``both_reports`` is stage 2 end to end: one staging of the window, then all
three reports. All queries are run to their last row once to warm up, and then
``BENCH_RUNS`` times each; the best run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.compare import session
from checks.registry import queries
from checks.telemetry import corrected_table, raw_table

HEADLINES = (
    "mode_cutoffs",
    "mode_correction",
    "parse_fields",
    "start_counts",
    "next_level_drop",
    "level_stats",
    "balance_sums",
    "non_return_d3",
    "incomplete_churn_last_start",
    "loss_distribution",
    "loss_report_all_levels",
    "levelplay_report_range",
    "levelplay_report_all_levels",
    "both_reports",
    "input_profile",
)


def timed(action) -> float:
    begun = time.perf_counter()
    action()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    results = {}
    setup = {
        "derive_raw": timed(lambda: raw_table(spark, sf_dir)),
        "stage1_write": timed(lambda: corrected_table(spark, sf_dir)),
    }
    registered = queries()
    names = sys.argv[1:] or HEADLINES

    def run(name: str) -> float:
        return timed(
            lambda: registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )

    for name in names:
        run(name)
    for name in names:
        results[name] = min(run(name) for _ in range(runs))
    print(
        json.dumps(
            {
                "metric": "stage 1 write and headline queries, total of best runs",
                "value": round(setup["stage1_write"] + sum(results.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in results.items()},
                "setup": {name: round(value, 3) for name, value in setup.items()},
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
