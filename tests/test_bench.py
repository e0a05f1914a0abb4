"""bench.py keeps its one-line JSON contract."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_ONLY="delays_by_month,label_contrast")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout.strip().splitlines()
    line = json.loads(out[-1])
    assert line["unit"] == "sec" and line["sf"] == 0.001
    assert set(line["queries"]) == {"delays_by_month", "label_contrast"}
    assert line["value"] == round(sum(line["queries"].values()), 3)
