"""Benchmark: build the star once, then time every registered job on it.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_JOBS (optional comma list).  Prints ONE JSON line.  Per job it also
reports the bytes read from files and written to shuffle, summed from
Spark's event log (written to a fresh scratch folder; no UI is started).

The warehouse is materialised as Parquet (facts partitioned by month) into a
fresh folder under the session's checkpoint folder, as a deployment would
keep it; each job is then forced with the ``noop`` sink, so the time covers
scan, joins, shuffles and aggregation but no driver collect.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aerostar import registry  # noqa: E402
from aerostar.session import checkpoint_dir, local_session  # noqa: E402
from aerostar.sources.star import build_star  # noqa: E402


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def io_per_job(log_dir: str) -> dict[str, dict[str, float]]:
    """MB scanned and MB shuffled per job description, from the event log."""
    stage_job: dict[int, str] = {}
    out: dict[str, dict[str, float]] = {}
    paths = sorted(os.path.join(root, f) for root, _, files in os.walk(log_dir)
                   for f in files if f.startswith("events") or f.startswith("local-"))
    for path in paths:  # rolling logs: events_1_..., events_2_... in order
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    desc = stage_job.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not desc or not m:
                        continue
                    acc = out.setdefault(desc, {"scan_mb": 0.0, "shuffle_mb": 0.0})
                    acc["scan_mb"] += m.get("Input Metrics", {}).get("Bytes Read", 0) / 2**20
                    acc["shuffle_mb"] += (m.get("Shuffle Write Metrics", {})
                                          .get("Shuffle Bytes Written", 0) / 2**20)
    return {k: {a: round(b, 2) for a, b in v.items()} for k, v in out.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    log_dir = tempfile.mkdtemp(prefix="aerostar-events-")
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app_name="aerostar-bench",
                          event_log_dir=log_dir)
    base = checkpoint_dir(spark)
    star_dir = tempfile.mkdtemp(prefix="star-", dir=base if base.startswith("/") else None)

    t0 = time.time()
    wh = build_star(spark, sf_dir, star_dir)
    build_sec = time.time() - t0

    registry._load_all()
    wanted = os.environ.get("BENCH_JOBS")
    names = [n for n in registry.JOBS if not wanted or n in wanted.split(",")]
    # One untimed warm-up so JIT/codegen start-up is not charged to the first job.
    force(registry.JOBS[names[0]](wh))
    times = {}
    for name in names:
        spark.sparkContext.setJobDescription(name)
        t = time.time()
        force(registry.JOBS[name](wh))
        times[name] = round(time.time() - t, 3)
    # ETL jobs read their raw source tables; the warehouse side is the stored star.
    etl = [n for n in registry.RAW_JOBS if not wanted or n in wanted.split(",")]
    for name in etl:
        spark.sparkContext.setJobDescription(name)
        t = time.time()
        force(registry.RAW_JOBS[name](spark, sf_dir, wh=wh))
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    spark.sparkContext.setJobDescription(None)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    spark.stop()  # flushes the event log
    try:
        io = {k: v for k, v in io_per_job(log_dir).items() if k in times}
    except Exception:  # metrics are informative only
        io = {}
    print(json.dumps({
        "metric": "total_job_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "star_build_sec": round(build_sec, 3),
        "report_jobs_sec": round(sum(times[n] for n in names), 3),
        "etl_jobs_sec": round(sum(times[n] for n in etl), 3),
        "jobs": len(times),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "io": io,
    }))


if __name__ == "__main__":
    main()
