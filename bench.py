"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_RUNS (default 2, the faster run counts) set the scale. Results go to the
noop sink: all rows are computed, none is kept.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import queries  # noqa: E402
from cohortlink.session import build_session  # noqa: E402

HEADLINE = [
    "cdm_visit",
    "cdm_condition",
    "cdm_measurement",
    "cdm_drug",
    "pii_name",
    "pii_phone",
    "pii_address",
    "site_cohort",
    "person_wide",
    "first_match",
    "second_match",
    "review_queue",
    "register_identifiers",
    "roster_duplicates",
    "roster_sync",
    "mrn_candidates",
    "best_mrn",
    "link_by_mrn",
    "merge_study_ids",
    "reconcile",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_ui_enabled="false",
        spark_driver_memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            known[name](spark, directory).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(directory).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
