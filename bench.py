"""Times the headline queries and prints one JSON line.

`BENCH_SF_DIR` is the folder of Parquet tables, `BENCH_CPUS` the number of local cores,
`BENCH_RUNS` the number of timed runs per query after one warm-up; the median counts. A run builds
the query, including what it stores on the way, and computes every row and column of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from faultline.plans.queries import QUERIES  # noqa: E402
from faultline.session import build_session  # noqa: E402

HEADLINE = [
    "clean_readings",
    "hourly_stats",
    "quarter_hour_stats",
    "stress_trend",
    "entity_hour_profile",
    "major_threshold_global",
    "activity_peaks",
    "critical_periods",
    "precursor_features_global",
    "precursor_features_entity",
    "precursor_conditions_global",
    "precursor_conditions_entity",
    "sequence_stats",
    "correlation_pairs_global",
    "risk_alerts",
    "message_roundtrip",
    "stream_risk_alerts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("faultline-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of the median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
