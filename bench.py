"""Benchmark the headline queries.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
(default 8). Per query: one warm-up run, then the median of ``$BENCH_RUNS``
(default 3) runs written to the ``noop`` sink, so the whole plan executes with
no result collected. Prints one JSON line. ``$BENCH_EVENT_LOG`` names a folder
for Spark's event log (stage and task times); off by default.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reelhouse import registry  # noqa: E402
from reelhouse.session import local_session  # noqa: E402

HEADLINE = {
    "D1_silver_ratings": "silver_ratings",
    "D4_silver_diary": "silver_diary",
    "G1_top_rated": "gold_top_rated_movies",
    "G3_best_year": "gold_best_movie_year",
    "G5_watch_activity": "gold_watch_activity",
    "R8_fingerprint": "fingerprint",
    "Q4_check_suite": "check_suite",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    conf = {}
    event_dir = os.environ.get("BENCH_EVENT_LOG")  # stage and task times, read offline
    if event_dir:
        conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir}
    spark = local_session(cpus, shuffle_partitions=max(2 * cpus, 8), **conf)

    times: dict[str, float | None] = {}
    all_samples: dict[str, list[float]] = {}
    errors: dict[str, str] = {}
    for label, name in HEADLINE.items():
        if only and label not in only:
            continue
        fn = registry.QUERIES[name]
        samples = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:  # the first run is a warm-up
                    samples.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 - report and go on, the JSON line must print
            times[label] = None
            errors[label] = str(e).splitlines()[0][:300]
            continue
        times[label] = round(statistics.median(samples), 3)
        all_samples[label] = [round(x, 3) for x in samples]

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_median",
                "value": round(sum(t for t in times.values() if t is not None), 3),
                "unit": "sec",
                "queries": times,
                "samples": all_samples,
                **({"errors": errors} if errors else {}),
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "spark": spark.version,
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
