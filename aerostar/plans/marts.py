"""Marts M01-M05 (the original's materialized views) and their refresh."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.functions.dates import DEFAULT_AS_OF, days_before
from aerostar.functions.measures import (check_mode, count_if, exact_avg, flight_costs, int_sum,
                                         money_sum,
                                         on_time, pct, ratio, rounded_avg, rows,
                                         weighted_avg)
from aerostar.plans.analytics import seat_miles
from aerostar.plans.common import airports, carriers, dim_cols, multiplicity, with_dates
from aerostar.sources.star import Warehouse


def monthly_flight_summary(wh: Warehouse, mode: str = "reference") -> DataFrame:
    """Flights, passengers, revenue, cost and punctuality per month and carrier.

    ``mode="corrected"`` counts a missing cost part as 0.
    """
    ff = with_dates(wh, wh.fact_flight, "Year", "Month", "MonthName")
    ff = carriers(wh, ff)
    return ff.groupBy("Year", "Month", "MonthName", "CarrierName").agg(
        rows().alias("TotalFlights"),
        int_sum("SeatsFilled").alias("TotalPassengers"),
        int_sum("SeatsAvailable").alias("TotalSeats"),
        rounded_avg("LoadFactor", 2, scale=2).alias("AvgLoadFactor"),
        money_sum("Revenue").alias("TotalRevenue"),
        money_sum(flight_costs(mode=mode)).alias("TotalCosts"),
        count_if(on_time()).alias("OnTimeFlights"),
        pct(count_if(on_time()), rows()).alias("OTP"),
        count_if(F.col("CancellationFlag")).alias("Cancellations"))


def route_performance(wh: Warehouse, min_flights: int = 10) -> DataFrame:
    """All-time route performance per airport pair, cities and carrier."""
    ff = airports(wh, wh.fact_flight,
                  {"OriginIATA": "IATA", "OriginCity": "City"},
                  {"DestinationIATA": "IATA", "DestinationCity": "City"})
    ff = carriers(wh, ff)
    return (ff.groupBy("OriginIATA", "DestinationIATA", "OriginCity", "DestinationCity",
                       "CarrierName").agg(
                rows().alias("TotalFlights"),
                exact_avg("DistanceMiles").alias("AvgDistance"),
                exact_avg("LoadFactor").alias("AvgLoadFactor"),
                money_sum("Revenue").alias("TotalRevenue"),
                ratio(F.sum("Revenue"), F.sum(seat_miles()), 4, scale=2).alias("RASM"),
                pct(count_if(on_time()), rows()).alias("OTP"),
                exact_avg("ArrivalDelayMin").alias("AvgDelay"))
            .filter(F.col("TotalFlights") >= min_flights))


def customer_ltv(wh: Warehouse) -> DataFrame:
    """Lifetime value per current customer (customers without bookings kept).

    Tenure is the day count between first and last booking (the original's
    ``EXTRACT(DAYS FROM date - date)`` intent).  Bookings are reduced to one
    row per customer before the join with the customer dimension.
    """
    per_customer = wh.fact_booking.groupBy("CustomerKey").agg(
        F.count("BookingKey").alias("n_bk"),
        F.sum("TotalAmount").alias("s_amt"),
        F.count("TotalAmount").alias("c_amt"),
        F.min("BookingDate").alias("first_bk"),
        F.max("BookingDate").alias("last_bk"),
        F.sum("LoyaltyPointsEarned").alias("s_earn"),
        count_if(F.col("CancellationFlag")).alias("n_cancel"))
    cust = dim_cols(wh, "customer", "CustomerKey", "CustomerID", "LoyaltyTier", current_only=True)
    j = cust.join(per_customer, "CustomerKey", "left")
    out = j.groupBy("CustomerKey", "CustomerID", "LoyaltyTier").agg(
        int_sum(F.coalesce(F.col("n_bk"), F.lit(0))).alias("TotalBookings"),
        money_sum("s_amt").alias("LifetimeRevenue"),
        ratio(F.sum("s_amt"), F.sum("c_amt")).alias("AvgBookingValue"),
        F.min("first_bk").alias("FirstBooking"),
        F.max("last_bk").alias("LastBooking"),
        int_sum("s_earn").alias("TotalPointsEarned"),
        int_sum(F.coalesce(F.col("n_cancel"), F.lit(0))).alias("Cancellations"),
        pct(F.sum("n_cancel"), F.sum("n_bk")).alias("CancellationRate"))
    return out.withColumn(
        "CustomerTenureDays",
        F.datediff(F.col("LastBooking"), F.col("FirstBooking")).cast("long"))


def aircraft_utilization_mart(wh: Warehouse, mode: str = "reference") -> DataFrame:
    """Utilisation and maintenance per current aircraft.

    The original LEFT JOINs flights and maintenance on the aircraft, so each
    side is repeated once per row of the other.  Both facts are reduced to
    one row per aircraft first (flights via one row per aircraft and day, to
    count operated days) and the repetition is applied as a weight.
    ``mode="corrected"`` reports each fact once: TotalFlights is the number
    of flights (0 without flights) and no sum is repeated.
    """
    corrected = check_mode(mode)
    keys = ["AircraftKey", "TailNumber", "Manufacturer", "Model", "Age"]
    per_day = wh.fact_flight.groupBy("AircraftKey", "DateKey").agg(
        rows().alias("n"), F.sum("AirTimeMin").alias("air"), F.sum("Revenue").alias("rev"),
        F.sum("LoadFactor").alias("lf"), F.count("LoadFactor").alias("lf_n"))
    flights = per_day.groupBy("AircraftKey").agg(
        F.sum("n").alias("n_f"), F.count("DateKey").alias("days"),
        F.sum("air").alias("s_air"), F.sum("rev").alias("s_rev"),
        F.sum("lf").alias("s_lf"), F.sum("lf_n").alias("c_lf"))
    maint = wh.fact_maintenance.groupBy("AircraftKey").agg(
        rows().alias("n_m"), F.count("MaintenanceKey").alias("c_mk"),
        F.sum("TotalCost").alias("s_cost"), F.sum("DowntimeHours").alias("s_down"))
    ac = dim_cols(wh, "aircraft", *keys, current_only=True)
    j = (ac.join(flights, "AircraftKey", "left").join(maint, "AircraftKey", "left")
         .withColumn("wf", multiplicity("n_f")).withColumn("wm", multiplicity("n_m")))
    wf, wm = F.col("wf"), F.col("wm")
    flights = F.sum(wf * wm)
    if corrected:
        wf = wm = F.lit(1).cast("long")
        flights = F.sum(F.coalesce(F.col("n_f"), F.lit(0)))
    return j.groupBy(*keys).agg(
        F.max(F.coalesce(F.col("days"), F.lit(0))).cast("long").alias("DaysOperated"),
        flights.cast("long").alias("TotalFlights"),
        (F.sum(F.col("s_air") * wm).cast("double") / 60.0).alias("TotalFlightHours"),
        weighted_avg(F.col("s_lf") * wm, F.col("c_lf") * wm).alias("AvgLoadFactor"),
        money_sum(F.col("s_rev") * wm).alias("TotalRevenue"),
        F.sum(F.coalesce(F.col("c_mk"), F.lit(0)) * wf).cast("long").alias("MaintenanceEvents"),
        money_sum(F.col("s_cost") * wf).alias("MaintenanceCosts"),
        money_sum(F.col("s_down") * wf).alias("TotalDowntime"))


def daily_operations(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF, days: int = 90) -> DataFrame:
    """Daily operations since ``as_of - days`` (later dates included)."""
    ff = with_dates(wh, wh.fact_flight, "Date", "DayOfWeek", "IsWeekend",
                    since=days_before(as_of, days))
    return ff.groupBy("Date", "DayOfWeek", "IsWeekend").agg(
        rows().alias("TotalFlights"),
        int_sum("SeatsFilled").alias("TotalPassengers"),
        exact_avg("LoadFactor").alias("AvgLoadFactor"),
        money_sum("Revenue").alias("TotalRevenue"),
        count_if(on_time()).alias("OnTimeFlights"),
        pct(count_if(on_time()), rows()).alias("OTP"),
        exact_avg("ArrivalDelayMin").alias("AvgDelay"),
        count_if(F.col("CancellationFlag")).alias("Cancellations"),
        count_if(F.col("WeatherImpactFlag")).alias("WeatherDelays"),
        count_if(F.col("MechanicalDelayFlag")).alias("MechanicalDelays"))


MARTS = {
    "mv_monthly_flight_summary": (monthly_flight_summary, ["Year"]),
    "mv_route_performance": (route_performance, []),
    "mv_customer_ltv": (customer_ltv, []),
    "mv_aircraft_utilization": (aircraft_utilization_mart, []),
    "mv_daily_operations": (daily_operations, []),
}


VERSIONS = "_versions"


def refresh_marts(wh: Warehouse, out_dir: str, label: str, as_of: dt.date = DEFAULT_AS_OF) -> dict[str, str]:
    """Recompute every mart into a folder of its own and publish them together.

    A refresh has a number, one more than the last, and writes
    ``<mart>/v=<label>-<number>-<random>``: nothing that a reader may hold is
    ever written again, also if the label repeats. When all marts are
    written, one file with a row a mart is added to the append-only list
    ``_versions``; until then readers see the refresh before. A failed
    refresh leaves folders that nothing lists.
    """
    spark = wh.fact_flight.sparkSession
    number = (mart_versions(spark, out_dir) or [0])[-1] + 1
    paths = {}
    for name, (fn, partition_by) in MARTS.items():
        df = fn(wh, as_of=as_of) if name == "mv_daily_operations" else fn(wh)
        path = f"{out_dir.rstrip('/')}/{name}/v={label}-{number}-{uuid.uuid4().hex[:8]}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
        paths[name] = path
    listed = [(number, label, name, path) for name, path in paths.items()]
    (spark.createDataFrame(listed, "version long, label string, mart string, path string").coalesce(1)
     .write.mode("append").parquet(f"{out_dir.rstrip('/')}/{VERSIONS}"))
    return paths


def _listed(spark, out_dir: str) -> DataFrame:
    try:
        return spark.read.parquet(f"{out_dir.rstrip('/')}/{VERSIONS}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":  # anything but "no refresh yet"
            raise
        return spark.createDataFrame([], "version long, label string, mart string, path string")


def mart_versions(spark, out_dir: str) -> list[int]:
    """The published refreshes, in order."""
    return [r.version for r in _listed(spark, out_dir).select("version").distinct().orderBy("version").collect()]


def current_mart(spark, out_dir: str, name: str, version: int | None = None) -> DataFrame:
    """Mart ``name`` of the refresh ``version`` (default: the last one published)."""
    rows = _listed(spark, out_dir).filter(F.col("mart") == name)
    if version is not None:
        rows = rows.filter(F.col("version") == version)
    found = rows.agg(F.max_by("path", "version").alias("path")).first()["path"]
    if found is None:
        raise ValueError(f"no published version of {name} in {out_dir}")
    return spark.read.parquet(found)
