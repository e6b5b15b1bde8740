"""Measure what a hot key sends through the dedupe shuffle.

Usage: python tools/skew_check.py [rows]

Builds ``rows`` rows in 8 partitions where one key (NULL) holds a third of
them and the rest spread over 1,000 keys, runs ``keep_first`` on it, and reads
the shuffle records written from Spark's event log (in a fresh scratch folder).
With the partial window group limit before the exchange, at most one row per
key and map task is shuffled, so the count stays near 8 x 1,001 however large
``rows`` is. The ``unique`` check on the same keys (the hot key made a value)
is measured the same way: its partial aggregate also sends one row per key and
map task. Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from reelhouse.operators.dedupe import keep_first  # noqa: E402
from reelhouse.session import local_session  # noqa: E402


def shuffle_records(event_dir: str) -> int:
    import zstandard

    total = 0
    for path in glob.glob(os.path.join(event_dir, "**", "events_*"), recursive=True) + glob.glob(
        os.path.join(event_dir, "local-*")
    ):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb")).read()
        for line in raw.decode().splitlines():
            event = json.loads(line)
            if event.get("Event") == "SparkListenerTaskEnd":
                metrics = event.get("Task Metrics") or {}
                total += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
    return total


def measure(rows: int, op) -> tuple[int, int]:
    """Run ``op`` on the skewed table in a fresh session; (result rows, shuffled rows)."""
    event_dir = tempfile.mkdtemp(prefix="skew-events-")
    spark = local_session(
        8, 8, **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir}
    )
    df = spark.range(0, rows, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").alias("v"),
    )
    n = op(df).count()
    spark.stop()
    return n, shuffle_records(event_dir)


def main(argv) -> None:
    from reelhouse.operators.checks import unique

    rows = int(argv[1]) if len(argv) > 1 else 3_000_000
    kept, shuffled = measure(rows, lambda df: keep_first(df, ["k"], ["v desc"]))
    dupes, shuffled_unique = measure(
        rows, lambda df: unique(df.withColumn("k", F.coalesce(F.col("k"), F.lit(-1))), "k")
    )
    print(json.dumps({"rows": rows, "hot_key_rows": (rows + 2) // 3, "kept": kept,
                      "shuffle_records_written": shuffled,
                      "unique_check_failures": dupes,
                      "unique_check_shuffle_records": shuffled_unique}))


if __name__ == "__main__":
    main(sys.argv)
