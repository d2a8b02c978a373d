"""Command line: list jobs, run one, build the star, refresh the marts.

    python -m aerostar list
    python -m aerostar run otp_by_route --sf-dir /data/src [--star /data/star] [--out /data/out] [--show 20]
    python -m aerostar run-all --sf-dir /data/src --star /data/star --out /data/reports [--jobs a,b]
    python -m aerostar build-star --sf-dir /data/src --out /data/star
    python -m aerostar refresh-marts --star /data/star --out /data/marts --version 20241231

Under ``spark-submit`` the submitted session (and its configuration) is used;
``--local N`` starts a local session instead.  ``run`` reads the materialised
star when ``--star`` is given, otherwise it derives the star from the source
tables.  Results are written with Spark (``--out``) or a bounded preview is
printed (``--show``); nothing unbounded is collected.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from aerostar import registry
from aerostar.session import apply_defaults, local_session
from aerostar.sources.star import build_star, derive_star, load_star


def _session(args) -> SparkSession:
    if args.local:
        return local_session(args.local)
    return apply_defaults(SparkSession.builder.appName("aerostar").getOrCreate())


def _run(args) -> int:
    registry._load_all()
    spark = _session(args)
    if args.job in registry.JOBS:
        wh = load_star(spark, args.star) if args.star else derive_star(spark, args.sf_dir)
        df = registry.JOBS[args.job](wh)
    elif args.job in registry.RAW_JOBS:
        wh = load_star(spark, args.star) if args.star else None
        df = registry.RAW_JOBS[args.job](spark, args.sf_dir, wh=wh)
    else:
        print(f"unknown job {args.job!r}; see 'list'", file=sys.stderr)
        return 2
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


def _run_all(args) -> int:
    """Write every report job (or ``--jobs``) to ``<out>/<job>`` as Parquet."""
    registry._load_all()
    spark = _session(args)
    wh = load_star(spark, args.star) if args.star else derive_star(spark, args.sf_dir)
    names = args.jobs.split(",") if args.jobs else list(registry.JOBS)
    unknown = [n for n in names if n not in registry.JOBS]
    if unknown:
        print(f"unknown report jobs: {unknown}", file=sys.stderr)
        return 2
    for name in names:
        registry.JOBS[name](wh).write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        print(name)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="aerostar", description=__doc__.split("\n")[0])
    parser.add_argument("--local", metavar="N", help="start a local[N] session")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the registered jobs")
    run = sub.add_parser("run", help="run one job")
    run.add_argument("job")
    run.add_argument("--sf-dir", required=True, help="folder of the source Parquet tables")
    run.add_argument("--star", help="folder of a materialised star (build-star)")
    run.add_argument("--out", help="write the result as Parquet here")
    run.add_argument("--show", type=int, default=20, help="rows to print when not writing")
    run_all = sub.add_parser("run-all", help="write every report job (or --jobs) as Parquet")
    run_all.add_argument("--sf-dir", required=True)
    run_all.add_argument("--star")
    run_all.add_argument("--out", required=True)
    run_all.add_argument("--jobs", help="comma-separated subset of report jobs")
    build = sub.add_parser("build-star", help="derive and materialise the star schema")
    build.add_argument("--sf-dir", required=True)
    build.add_argument("--out", required=True)
    marts = sub.add_parser("refresh-marts", help="recompute the marts into a new version")
    marts.add_argument("--star", required=True)
    marts.add_argument("--out", required=True)
    marts.add_argument("--version", default=dt.date.today().strftime("%Y%m%d"))
    marts.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    args = parser.parse_args(argv)

    if args.cmd == "list":
        registry._load_all()
        for name in [*registry.JOBS, *registry.RAW_JOBS]:
            print(name)
        return 0
    if args.cmd == "run":
        return _run(args)
    if args.cmd == "run-all":
        return _run_all(args)
    spark = _session(args)
    if args.cmd == "build-star":
        build_star(spark, args.sf_dir, args.out)
        return 0
    from aerostar.plans.marts import refresh_marts
    kwargs = {"as_of": args.as_of} if args.as_of else {}
    for name, path in refresh_marts(load_star(spark, args.star), args.out, args.version,
                                    **kwargs).items():
        print(name, path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
