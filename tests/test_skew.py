"""A hot customer without broadcasts: no shuffle or task grows beyond what the candidates need."""

import json
import os
import subprocess
import sys

from conftest import ROOT


def test_hot_customer_without_broadcasts(tmp_path):
    run = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tools", "skew_check.py"), "/root/testdata/sf0.01", str(tmp_path), "--no-broadcast"],
        capture_output=True, text=True, timeout=900, check=True,
    )
    found = json.loads(run.stdout.strip().splitlines()[-1])
    assert found["hot_share"] > 0.3
    # A third of 60,000 lines on one customer: about 170,000 candidates.
    assert found["largest_shuffle_mb"] < 15
    assert found["largest_task_write_mb"] < 3
    assert found["worst_task_share"] < 0.35
