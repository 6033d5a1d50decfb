"""A key or group holding a third of all rows is reduced before the shuffle."""

import json
import os
import subprocess
import sys
import tempfile

HERE = os.path.dirname(os.path.abspath(__file__))


def probe(case: str, limit_on: bool) -> dict:
    log_dir = tempfile.mkdtemp(prefix="tessera-evlog-")
    out = subprocess.run([sys.executable, os.path.join(HERE, "skew_probe.py"), log_dir, case,
                          "1" if limit_on else "0"], capture_output=True, text=True, timeout=600)
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_hot_key_dedup_ships_one_row_per_map_task():
    on, off = probe("dedup", True), probe("dedup", False)
    assert on["rows"] == off["rows"] == on["expect_rows"]
    n = 120_000
    # without the partial limit every copy of the hot key is shuffled
    assert off["shuffle_records"] >= n
    # with it the hot key contributes at most one row per map task (6 tasks);
    # the count() adds one partial count per shuffle partition (4)
    assert on["shuffle_records"] <= (n - n // 3) + 6 + 4


def test_hot_group_rank_is_reduced_before_the_shuffle():
    got = probe("rank", True)
    # the histogram has at most 997 values a group; no task gets the hot group's 40,000 rows
    assert got["most_in_a_task"] < 40_000


def test_hot_month_of_ties_is_ranked_whole():
    got = probe("tied", True)
    assert got["rows"] == got["expect_rows"]  # every item ties at the least rank
    # four tasks share the 80,000 other rows evenly; the hot 40,000 went through no window
    assert got["most_in_a_task"] < 30_000
