import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py"), "uri_split", "transfer_totals"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=REPO)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == "0.001" and set(d["queries"]) == {"uri_split", "transfer_totals"}
