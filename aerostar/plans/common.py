"""Join helpers shared by the report jobs."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostar.functions.dates import key_of
from aerostar.sources.star import BOUNDED_DIMS, Warehouse, restrict_dates


def dim_cols(wh: Warehouse, name: str, *cols: str | Column, current_only: bool = False,
             **renames: str) -> DataFrame:
    """Columns of a dimension (renamed), broadcast only if size-bounded."""
    df = getattr(wh, name)
    if current_only:
        df = df.filter(F.col("IsCurrent"))
    out = df.select(*cols, *[F.col(src).alias(dst) for dst, src in renames.items()])
    return F.broadcast(out) if name in BOUNDED_DIMS else out


def airports(wh: Warehouse, fact: DataFrame, dep: dict[str, str], arr: dict[str, str]) -> DataFrame:
    """Role-playing airport joins: ``dep``/``arr`` map output name -> attribute."""
    d = dim_cols(wh, "airport", DepartureAirportKey="AirportKey", **dep)
    a = dim_cols(wh, "airport", ArrivalAirportKey="AirportKey", **arr)
    return fact.join(d, "DepartureAirportKey").join(a, "ArrivalAirportKey")


def carriers(wh: Warehouse, fact: DataFrame) -> DataFrame:
    return fact.join(dim_cols(wh, "carrier", "CarrierKey", "CarrierName"), "CarrierKey")


def with_dates(wh: Warehouse, fact: DataFrame, *attrs: str, year: int | None = None,
               year_from: int | None = None, since: dt.date | None = None) -> DataFrame:
    """Inner join to the date dimension, restricted to a calendar window.

    The window is applied twice: to the (broadcast) date rows, and as a
    DateKey range on the fact so it reaches the Parquet scan.
    """
    days = wh.date
    lo = hi = None
    if year is not None:
        days = days.filter(F.col("Year") == year)
        lo, hi = year * 10000 + 101, year * 10000 + 1231
    if year_from is not None:
        days = days.filter(F.col("Year") >= year_from)
        lo = year_from * 10000 + 101
    if since is not None:
        days = days.filter(F.col("Date") >= F.lit(since))
        lo = key_of(since)
    fact = restrict_dates(fact, lo, hi)
    days = F.broadcast(days.select("DateKey", *attrs))
    return fact.join(days, "DateKey", "left_semi" if not attrs else "inner")


def scheduled(wh: Warehouse, fact: DataFrame) -> DataFrame:
    """Inner join to DimFlight without its columns.

    FlightKey is the dimension's primary key, so the inner join only drops
    orphan facts: a semi join says exactly that and carries no columns.
    """
    return fact.join(wh.flight.select("FlightKey"), "FlightKey", "left_semi")


def multiplicity(n: Column | str) -> Column:
    """Rows one key contributes to a LEFT JOIN side: max(n, 1)."""
    c = F.col(n) if isinstance(n, str) else n
    return F.greatest(F.coalesce(c, F.lit(0)).cast("long"), F.lit(1).cast("long"))


def join_on_groups(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner", bounded_right: bool = False) -> DataFrame:
    """Join two aggregates on (nullable) group keys with NULL-safe equality.

    ``bounded_right``: the right side has a proven size bound (e.g. one row
    per calendar month) and is broadcast.
    """
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    if bounded_right:
        r = F.broadcast(r)
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])
