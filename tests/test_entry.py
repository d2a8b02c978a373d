"""The warehouse queries don't depend on the optional part or on what it needs."""
import subprocess
import sys

from conftest import ROOT

CODE = """
import sys
sys.path.insert(0, {root!r})
for name in {hidden!r}:
    sys.modules[name] = None
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), any(q.startswith("op") and q[2].isdigit() for q in e.queries()))
"""


def _entry(hidden):
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, hidden=hidden)], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def test_queries_without_the_optional_part_or_its_libraries():
    alone = _entry(["aerostar.llm"])
    assert int(alone[0]) >= 74 and alone[2] == "False"
    assert _entry(["xxhash", "ahocorasick"]) == alone
