"""Directory, KPI and top-k reports behind the dashboard app, notebook,
README examples and setup script (D01-D14, N01, R01-R03, S01-S02)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.functions.dates import DEFAULT_AS_OF, age_in_years
from aerostar.functions.measures import (count_if, exact_avg, money_sum, on_time, pct,
                                         rounded_avg, rows)
from aerostar.plans.analytics import route_label
from aerostar.plans.common import airports, carriers
from aerostar.sources.star import Warehouse


def _current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("IsCurrent"))


def _labelled_counts(parts: list[tuple[str, DataFrame]], label: str, value: str) -> DataFrame:
    out = None
    for name, df in parts:
        one = df.agg(rows().alias(value)).select(F.lit(name).alias(label), value)
        out = one if out is None else out.unionByName(one)
    return out


def current_counts(wh: Warehouse) -> DataFrame:
    """Number of current airports, carriers, aircraft and customers."""
    return _labelled_counts([
        ("Total Airports", _current(wh.airport)),
        ("Total Carriers", _current(wh.carrier)),
        ("Total Aircraft", _current(wh.aircraft)),
        ("Total Customers", _current(wh.customer)),
    ], "Metric", "Count")


def airport_directory(wh: Warehouse) -> DataFrame:
    """Current airports by name."""
    return (_current(wh.airport).select(
                "IATA", "AirportName", "City", "Country", "Region",
                F.col("Latitude").cast("double").alias("Latitude"),
                F.col("Longitude").cast("double").alias("Longitude"))
            .orderBy(F.col("AirportName").asc_nulls_last()))


def _value_counts(df: DataFrame, col: str, name: str) -> DataFrame:
    """pandas ``value_counts``: NULL dropped, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(rows().alias(name))
            .orderBy(F.col(name).desc(), F.col(col)))


def airports_by_region(wh: Warehouse) -> DataFrame:
    """Current airports per region."""
    return _value_counts(airport_directory(wh), "Region", "Airports")


def fleet_directory(wh: Warehouse) -> DataFrame:
    """Current aircraft by age."""
    return (_current(wh.aircraft).select(
                "TailNumber", "Manufacturer", "Model", "AircraftType", "SeatingCapacity",
                "ManufactureYear", "Age", "OwnershipType")
            .orderBy(F.col("Age").asc_nulls_last()))


def fleet_by_manufacturer(wh: Warehouse) -> DataFrame:
    """Current aircraft per manufacturer."""
    return _value_counts(fleet_directory(wh), "Manufacturer", "Aircraft")


def fleet_age_histogram(wh: Warehouse, bins: int = 20) -> DataFrame:
    """Equal-width histogram of current aircraft age (non-empty bins).

    Bin i covers [min + (i-1)*w, min + i*w) with w = (max - min) / bins; the
    maximum falls in the last bin; all ages fall in bin 1 when min = max.
    The bounds are scalar subqueries, so nothing is collected.
    """
    ages = fleet_directory(wh).select("Age").filter(F.col("Age").isNotNull())
    # Both bounds in one scalar subquery, projected once and reused by name.
    bounds = ages.select(F.struct(F.min("Age").alias("lo"), F.max("Age").alias("hi"))).scalar()
    ages = ages.select("Age", bounds.alias("__b")).select(
        "Age", F.col("__b.lo").alias("lo"), F.col("__b.hi").alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    span = (hi - lo).cast("double")
    width = span / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((F.col("Age") - lo).cast("double") * bins / span) + 1,
                F.lit(bins))).cast("int")
    binned = ages.withColumn("Bin", b)
    return (binned.groupBy("Bin", "lo", "hi").agg(rows().alias("Aircraft"))
            .select("Bin",
                    (lo.cast("double") + (F.col("Bin") - 1).cast("double") * width).alias("BinStart"),
                    (lo.cast("double") + F.col("Bin").cast("double") * width).alias("BinEnd"),
                    "Aircraft")
            .orderBy("Bin"))


def top_customers(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF, n: int = 100) -> DataFrame:
    """The ``n`` current customers with most loyalty points.

    Top-k is the feature here (the limit is the report); ties are broken by
    CustomerID, then CustomerKey, so the selection is deterministic.
    """
    return (_current(wh.customer)
            .orderBy(F.col("LoyaltyPoints").desc_nulls_first(), F.col("CustomerID").asc_nulls_last(),
                     F.col("CustomerKey").asc_nulls_last())
            .limit(n)
            .select("CustomerID", "FirstName", "LastName", "Email", "LoyaltyTier",
                    "LoyaltyPoints", "Country", "City",
                    age_in_years(as_of, F.col("BirthDate")).alias("Age")))


def tier_distribution_top(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF, n: int = 100) -> DataFrame:
    """Loyalty tiers among the top-``n`` customers of D10."""
    return _value_counts(top_customers(wh, as_of, n), "LoyaltyTier", "Customers")


def top10_customers(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    """The first ten rows of D10."""
    return top_customers(wh, as_of, 100).limit(10)


def carrier_directory(wh: Warehouse) -> DataFrame:
    """Current carriers by name."""
    return (_current(wh.carrier).select("AirlineCode", "CarrierName", "AllianceCode", "Country")
            .orderBy(F.col("CarrierName").asc_nulls_last()))


def carriers_by_alliance(wh: Warehouse) -> DataFrame:
    """Current carriers per alliance (carriers without one are dropped)."""
    return _value_counts(carrier_directory(wh), "AllianceCode", "Carriers")


def date_coverage(wh: Warehouse) -> DataFrame:
    """Span and special-day counts of the date dimension."""
    return wh.date.agg(
        F.min("Date").alias("StartDate"), F.max("Date").alias("EndDate"),
        rows().alias("TotalDays"),
        count_if(F.col("IsWeekend")).alias("WeekendDays"),
        count_if(F.col("HolidayFlag")).alias("Holidays"))


def otp_top_routes(wh: Warehouse, n: int = 20) -> DataFrame:
    """The ``n`` city-pair routes and carriers with the best on-time rate."""
    ff = carriers(wh, airports(wh, wh.fact_flight, {"DepartureCity": "City"},
                               {"ArrivalCity": "City"}))
    return (ff.withColumn("Route", route_label()).groupBy("Route", "CarrierName").agg(
                rows().alias("TotalFlights"),
                pct(count_if(on_time()), rows()).alias("OnTimePercentage"))
            .orderBy(F.col("OnTimePercentage").desc_nulls_first(), F.col("Route").asc_nulls_last(),
                     F.col("CarrierName").asc_nulls_last())
            .limit(n))


# Route separator of the README example (fixed value).
ARROW = " → "


def top_routes_by_revenue(wh: Warehouse, n: int = 10) -> DataFrame:
    """The ``n`` city-pair routes with most revenue."""
    ff = airports(wh, wh.fact_flight, {"DepartureCity": "City"}, {"ArrivalCity": "City"})
    return (ff.withColumn("Route", route_label(ARROW)).groupBy("Route").agg(
                money_sum("Revenue").alias("TotalRevenue"),
                rows().alias("FlightCount"))
            .orderBy(F.col("TotalRevenue").desc_nulls_first(), F.col("Route").asc_nulls_last())
            .limit(n))


def loyalty_tier_summary(wh: Warehouse) -> DataFrame:
    """Current customers and average points per tier."""
    return (_current(wh.customer).groupBy("LoyaltyTier").agg(
                rows().alias("CustomerCount"),
                exact_avg("LoyaltyPoints").alias("AvgPoints"))
            .orderBy(F.col("AvgPoints").desc_nulls_first()))


def fleet_summary(wh: Warehouse) -> DataFrame:
    """Current aircraft count and average age per manufacturer and model."""
    return (_current(wh.aircraft).groupBy("Manufacturer", "Model").agg(
                rows().alias("AircraftCount"),
                exact_avg("Age").alias("AvgAge"))
            .orderBy(F.col("AircraftCount").desc_nulls_first()))


def table_counts(wh: Warehouse) -> DataFrame:
    """Row counts (all versions) of the main tables."""
    return _labelled_counts([
        ("Airports", wh.airport), ("Carriers", wh.carrier), ("Aircraft", wh.aircraft),
        ("Customers", wh.customer), ("Flights", wh.fact_flight),
    ], "Dimension", "Count").orderBy("Dimension")


def kpi_overview(wh: Warehouse) -> DataFrame:
    """Global flight KPIs over non-cancelled flights."""
    ff = wh.fact_flight.filter(~F.col("CancellationFlag"))
    return ff.agg(
        rows().alias("TotalFlights"),
        rounded_avg("LoadFactor", 2, scale=2).alias("AvgLoadFactor"),
        pct(count_if(on_time()), rows()).alias("OnTimePercentage"),
        rounded_avg("ArrivalDelayMin", 2).alias("AvgDelayMinutes"))
