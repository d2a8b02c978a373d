"""Source readers: time-window extract (E07) and the flight schedule CSV."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def extract_window(source: DataFrame, ts_col: str, start: dt.datetime,
                   end: dt.datetime) -> DataFrame:
    """Rows with ``start <= ts_col <= end``.

    A plain range predicate on the source column: it reaches the Parquet
    scan as pushed filters, and on a source partitioned by date it prunes
    directories as well.
    """
    c = F.col(ts_col)
    return source.filter((c >= F.lit(start)) & (c <= F.lit(end)))


SCHEDULE_SCHEMA = T.StructType([
    T.StructField("FlightNumber", T.StringType()),
    T.StructField("CarrierCode", T.StringType()),
    T.StructField("DepartureAirport", T.StringType()),
    T.StructField("ArrivalAirport", T.StringType()),
    T.StructField("ScheduledDeparture", T.StringType()),
    T.StructField("ScheduledArrival", T.StringType()),
    T.StructField("DistanceMiles", T.IntegerType()),
])


def _minutes(hhmmss: F.Column) -> F.Column:
    parts = F.split(hhmmss, ":")
    return (parts.getItem(0).cast("int") * 60 + parts.getItem(1).cast("int")).cast("int")


def read_schedule(spark: SparkSession, path: str) -> DataFrame:
    """The flight schedule CSV with an explicit schema.

    Times are kept as minutes after midnight (Parquet cannot store TIME);
    the duration wraps past midnight for overnight flights.
    """
    raw = spark.read.schema(SCHEDULE_SCHEMA).option("header", True).csv(path)
    dep, arr = _minutes(F.col("ScheduledDeparture")), _minutes(F.col("ScheduledArrival"))
    return raw.select(
        "FlightNumber", "CarrierCode", "DepartureAirport", "ArrivalAirport",
        dep.alias("ScheduledDepartureMin"), arr.alias("ScheduledArrivalMin"),
        F.pmod(arr - dep, F.lit(24 * 60)).alias("ScheduledDurationMin"),
        "DistanceMiles")


def schedule_to_dim_flight(schedule: DataFrame, airports: DataFrame, carriers: DataFrame,
                           first_key: int = 1) -> DataFrame:
    """Schedule rows as DimFlight rows (IATA / airline code -> surrogate keys).

    Unknown codes keep a NULL key (left joins), to be caught by P13.
    """
    dep = airports.select(F.col("IATA").alias("DepartureAirport"),
                          F.col("AirportKey").alias("DepartureAirportKey"))
    arr = airports.select(F.col("IATA").alias("ArrivalAirport"),
                          F.col("AirportKey").alias("ArrivalAirportKey"))
    car = carriers.select(F.col("AirlineCode").alias("CarrierCode"), "CarrierKey")
    j = (schedule.join(dep, "DepartureAirport", "left").join(arr, "ArrivalAirport", "left")
         .join(car, "CarrierCode", "left"))
    rows = j.select(
        "FlightNumber", "CarrierKey", "DepartureAirportKey", "ArrivalAirportKey",
        "ScheduledDepartureMin", "ScheduledArrivalMin", "ScheduledDurationMin", "DistanceMiles",
        F.concat_ws("-", "DepartureAirport", "ArrivalAirport").alias("RouteCode"))
    from aerostar.operators.keys import assign_keys
    keyed = assign_keys(rows, "FlightKey", ["FlightNumber"], start=first_key - 1)
    return keyed.select("FlightKey", *[c for c in rows.columns])


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, partitions: int, properties: dict | None = None) -> DataFrame:
    """An operational source table read in ``partitions`` parallel range slices.

    The original pulls query results over one database connection; here each
    task reads its own slice of ``partition_column`` in [lower, upper], and
    filters / projections on the result are pushed to the database.
    """
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=partitions,
                           properties=properties or {})
