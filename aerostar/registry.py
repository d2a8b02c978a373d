"""Registered jobs: name -> callable(spark, sf_dir) -> DataFrame.

Every job reads the driver's tables through ``derive_star`` (so its work
grows with them) and then runs one report / ETL step on the warehouse.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerostar.sources.star import Warehouse, derive_star

# Jobs over the warehouse: fn(wh) -> DataFrame.
JOBS: dict[str, Callable[[Warehouse], DataFrame]] = {}
# ETL jobs that also read raw source tables: fn(spark, sf_dir) -> DataFrame.
RAW_JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def job(name: str):
    def register(fn: Callable[[Warehouse], DataFrame]):
        JOBS[name] = fn
        return fn
    return register


def raw_job(name: str):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        RAW_JOBS[name] = fn
        return fn
    return register


def _load_all() -> None:
    # Importing the modules registers their jobs.
    from aerostar.plans import etl_jobs, jobs  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def bind(fn):
        return lambda spark, sf_dir: fn(derive_star(spark, sf_dir))

    out = {name: bind(fn) for name, fn in JOBS.items()}
    out.update(RAW_JOBS)
    return out


def oracle_sql() -> dict[str, str]:
    _load_all()
    from aerostar.oracle.etl_texts import ETL_TEXTS
    from aerostar.oracle.texts import TEXTS
    texts = {**TEXTS, **ETL_TEXTS}
    return {name: texts[name] for name in [*JOBS, *RAW_JOBS] if name in texts}
