"""A hot key (a third of the rows) sends at most one row per map task through
the dedupe shuffle: measured from Spark's event log in a separate process."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_key_is_cut_before_the_shuffle():
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tools", "skew_check.py"), "600000"],
        capture_output=True, text=True, timeout=600, check=True,
    )
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["kept"] == 1001
    assert result["hot_key_rows"] == 200000
    # 8 map tasks x 1,001 keys at most (plus a handful of rows for the count)
    assert result["shuffle_records_written"] <= 8 * 1001 + 16
    # the unique check: every key repeats, the hot one 200,000 times
    assert result["unique_check_failures"] == 1001
    assert result["unique_check_shuffle_records"] <= 8 * 1001 + 16
