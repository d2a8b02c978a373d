"""Data-quality checks (Q01-Q04 and the documented rules P12-P16).

Each check is a count of failing rows computed on the executors; a report
is one DataFrame of (CheckName, Failures, Passed) rows, never a loop of
driver-side queries.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostar.functions.dates import DEFAULT_AS_OF
from aerostar.functions.measures import count_if, rows
from aerostar.sources.star import Warehouse


def orphan_count(fact: DataFrame, key: str, dim_keys: DataFrame) -> Column:
    """Number of fact rows with a non-NULL ``key`` missing from ``dim_keys``.

    The fact is first counted per key (a partial aggregation: each task
    sends one row per distinct key), so only key counts -- never fact rows --
    meet the dimension in the anti join.  Returned as a scalar subquery.
    """
    per_key = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(rows().alias("__n"))
    missing = per_key.join(dim_keys.select(key), key, "left_anti")
    return missing.select(F.coalesce(F.sum("__n"), F.lit(0)).cast("long")).scalar()


def dq_orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose ``key`` has no row in ``dim``."""
    keys = dim.select(F.col(dim_key or key).alias(key))
    per_key = fact.groupBy(key).agg(rows().alias("__n"))
    return (per_key.join(keys, key, "left_anti")
            .agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("Failures")))


def dq_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Rows with ``col`` outside ``[lo, hi]`` (NULL passes)."""
    return df.agg(count_if(out_of_range(F.col(col), lo, hi)).alias("Failures"))


def out_of_range(c: Column, lo=None, hi=None) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < lo)
    if hi is not None:
        cond = cond | (c > hi)
    return cond


def dq_future(fact: DataFrame, dim_date: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """Q03: facts dated after ``as_of`` (keys missing from the calendar are not counted)."""
    future = F.broadcast(dim_date.filter(F.col("Date") > F.lit(as_of)).select("DateKey"))
    return fact.join(future, "DateKey", "left_semi").agg(rows().alias("Failures"))


def _report(one_row: DataFrame, names: list[str]) -> DataFrame:
    """Unpivot a one-row frame of counts into (CheckName, Failures, Passed)."""
    items = F.array(*[F.struct(F.lit(n).alias("CheckName"), F.col(n).cast("long").alias("Failures"))
                      for n in names])
    return (one_row.select(F.inline(items))
            .withColumn("Passed", F.col("Failures") == 0))


def dq_report(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """Q04: the three flight checks of the ETL as one (CheckName, Failures, Passed) frame.

    The fact is read once: the calendar rows after ``as_of`` (broadcast,
    bounded by the calendar) flag each row, all three counts are kept per
    FlightKey (a partial aggregation, one row per task and key), and only
    those counts meet the flight keys. A row without FlightKey is an orphan.
    """
    future = F.broadcast(wh.date.filter(F.col("Date") > F.lit(as_of)).select(F.col("DateKey").alias("__day")))
    flagged = wh.fact_flight.join(future, F.col("DateKey") == F.col("__day"), "left")
    per_key = flagged.groupBy("FlightKey").agg(
        rows().alias("n"), count_if(out_of_range(F.col("LoadFactor"), 0, 100)).alias("bad_loads"),
        count_if(F.col("__day").isNotNull()).alias("late"))
    known = wh.flight.select(F.col("FlightKey").alias("__known")).distinct()
    total = lambda value: F.coalesce(F.sum(value), F.lit(0))
    counts = per_key.join(known, F.col("FlightKey") == F.col("__known"), "left").agg(
        total(F.when(F.col("__known").isNull(), F.col("n"))).alias("orphaned_flights"),
        total(F.col("bad_loads")).alias("invalid_load_factors"), total(F.col("late")).alias("future_dates"))
    return _report(counts, ["orphaned_flights", "invalid_load_factors", "future_dates"])


# Documented rules (second priority) -------------------------------------

FLIGHT_FKS = {
    "FlightKey": ("flight", "FlightKey"),
    "DateKey": ("date", "DateKey"),
    "AircraftKey": ("aircraft", "AircraftKey"),
    "DepartureAirportKey": ("airport", "AirportKey"),
    "ArrivalAirportKey": ("airport", "AirportKey"),
    "CarrierKey": ("carrier", "CarrierKey"),
    "WeatherKey": ("weather", "WeatherKey"),
}


def dq_referential(wh: Warehouse) -> DataFrame:
    """Orphan count per foreign key of FactFlight (NULL optional keys pass).

    Each key is counted per value on a one-column scan (partial aggregation)
    and only those counts are anti-joined with the dimension's keys.
    """
    fact = wh.fact_flight
    counts = fact.sparkSession.range(1).select(*[
        orphan_count(fact, col, getattr(wh, dim_name).select(F.col(dim_key).alias(col)))
        .alias(f"orphan_{col}")
        for col, (dim_name, dim_key) in FLIGHT_FKS.items()])
    return _report(counts, [f"orphan_{c}" for c in FLIGHT_FKS])


def dq_ranges(wh: Warehouse) -> DataFrame:
    """LoadFactor 0..100, Revenue >= 0, delays -60..1440 in one pass."""
    ff = wh.fact_flight
    counts = ff.agg(
        count_if(out_of_range(F.col("LoadFactor"), 0, 100)).alias("load_factor_range"),
        count_if(out_of_range(F.col("Revenue"), 0, None)).alias("negative_revenue"),
        count_if(out_of_range(F.col("DepartureDelayMin"), -60, 1440)).alias("departure_delay_range"),
        count_if(out_of_range(F.col("ArrivalDelayMin"), -60, 1440)).alias("arrival_delay_range"))
    return _report(counts, ["load_factor_range", "negative_revenue", "departure_delay_range",
                            "arrival_delay_range"])


def dq_duplicates(df: DataFrame, key: str = "FlightFactKey") -> DataFrame:
    """Keys that occur more than once, with their multiplicity.

    The per-key count is partially aggregated before the shuffle, so a key
    holding a large share of the rows still moves one row per task.
    """
    return (df.groupBy(key).agg(rows().alias("Occurrences"))
            .filter(F.col("Occurrences") > 1))


def dq_current_versions(dim: DataFrame, business_key: str = "CustomerID") -> DataFrame:
    """Business keys with more than one current version in a type-2 dimension.

    SCD2 then uses the version with the highest surrogate key; this check
    reports the ambiguity (one row per affected key, with its count).
    """
    return (dim.filter(F.col("IsCurrent")).groupBy(business_key)
            .agg(rows().alias("CurrentVersions"))
            .filter(F.col("CurrentVersions") > 1))


def dq_dates(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """Date keys missing from the calendar, future dates, and arrivals not after their departure.

    The actual times are whole timestamps, so a flight that lands after
    midnight is in order; flights without times (cancelled) are left out.
    A fact without these columns fails instead of passing unchecked.
    """
    ff = wh.fact_flight
    if missing := {"ActualDepartureTime", "ActualArrivalTime"} - set(ff.columns):
        raise ValueError(f"the flight facts have no {', '.join(sorted(missing))}")
    days = F.broadcast(wh.date.select("DateKey", (F.col("Date") > F.lit(as_of)).alias("_future"))
                       .withColumn("_known", F.lit(True)))
    counts = ff.join(days, "DateKey", "left").agg(
        count_if(F.col("_known").isNull()).alias("date_not_in_calendar"),
        count_if(F.col("_future")).alias("future_dates"),
        count_if(F.col("ActualArrivalTime") <= F.col("ActualDepartureTime")).alias("arrival_not_after_departure"))
    return _report(counts, ["date_not_in_calendar", "future_dates", "arrival_not_after_departure"])


def dq_required_defaults(batch: DataFrame, required=("FlightKey", "DateKey", "AircraftKey",
                                                      "DepartureAirportKey", "ArrivalAirportKey"),
                         defaulted=("DepartureDelayMin", "ArrivalDelayMin", "CancellationFlag")
                         ) -> DataFrame:
    """Records missing a required key (rejected) and records whose
    optional fields take the documented defaults, counted in one pass."""
    aggs = [count_if(reduce_or([F.col(c).isNull() for c in required])).alias("missing_required_keys")]
    aggs += [count_if(F.col(c).isNull()).alias(f"defaulted_{c}") for c in defaulted]
    return _report(batch.agg(*aggs), ["missing_required_keys"] + [f"defaulted_{c}" for c in defaulted])


def reduce_or(conds: list[Column]) -> Column:
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out
