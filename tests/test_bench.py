"""bench.py prints one JSON line with the fields the driver records."""
import json
import os
import subprocess
import sys

from conftest import ROOT, SMALL


def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_CPUS="2",
               BENCH_JOBS="otp_by_route,booking_totals")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and set(d["queries"]) == {"otp_by_route", "booking_totals"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
