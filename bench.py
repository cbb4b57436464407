"""Benchmark: wall-clock of every report run (the headline workload).

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed to completion through the ``noop`` sink (the whole
plan runs, nothing is collected), warm, median of ``BENCH_RUNS`` runs.
Prints one JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from accrualkit.plans.monthly import month_end_runs  # noqa: E402
from accrualkit.plans.registry import REPORTS  # noqa: E402
from accrualkit.session import build_session  # noqa: E402
from accrualkit.sources.catalog import SourceCatalog  # noqa: E402

# the month in which every report family has data in the generated tables
MONTH_END = "2024-01-01"


def shuffle_partitions_for(sf_dir: str, cpus: int, target_bytes: int = 128 << 20) -> int:
    """About one shuffle partition per 128 MB of input, at least one per core."""
    total = 0
    for root, _, files in os.walk(sf_dir):
        total += sum(os.path.getsize(os.path.join(root, f)) for f in files)
    return max(cpus, -(-total // target_bytes))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_ONLY")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = build_session(
        f"local[{cpus}]", shuffle_partitions=shuffle_partitions_for(sf_dir, cpus), app_name="accrualkit-bench"
    )
    names = [n for n in REPORTS if not only or only in n]

    # warm-up: JIT, file listing, and the one-off storing of the stand-in
    # input tables (they play the warehouse tables, which already exist)
    for n in names:
        REPORTS[n](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for n in names:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            REPORTS[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[n] = round(statistics.median(samples), 3)
        print(f"{n}: {timings[n]}s", file=sys.stderr)

    # the whole month-end (13 runs) with the event-log work shared
    month_end = None
    if not only:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            for build in month_end_runs(SourceCatalog.from_testdata(spark, sf_dir), MONTH_END).values():
                build().write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        month_end = round(statistics.median(samples), 3)
        print(f"month_end_suite: {month_end}s", file=sys.stderr)

    print(
        json.dumps(
            {
                "metric": "report_suite_total_median",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "month_end_suite_sec": month_end,
                "sf": sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
