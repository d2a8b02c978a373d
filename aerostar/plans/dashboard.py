"""Dashboard views V01-V12 (operational, commercial, financial, customer)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostar.functions.dates import DEFAULT_AS_OF, days_before
from aerostar.functions.measures import (ON_TIME_MINUTES, check_mode, count_if, exact_avg,
                                         flight_costs,
                                         int_sum, money_sum, on_time, pct, ratio, rows,
                                         weighted_avg)
from aerostar.plans.analytics import profitability, seat_miles
from aerostar.plans.common import (airports, carriers, dim_cols, join_on_groups, multiplicity,
                                   scheduled, with_dates)
from aerostar.sources.star import Warehouse, restrict_dates


def daily_otp(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF, days: int = 30) -> DataFrame:
    """Daily on-time performance since ``as_of - days`` (not cancelled)."""
    ff = with_dates(wh, wh.fact_flight.filter(~F.col("CancellationFlag")), "Date",
                    since=days_before(as_of, days))
    return (ff.groupBy("Date").agg(
                rows().alias("TotalFlights"),
                count_if(on_time()).alias("OnTimeFlights"),
                pct(count_if(on_time()), rows()).alias("OTP"),
                exact_avg("ArrivalDelayMin").alias("AvgDelay"))
            .orderBy("Date"))


def delay_causes(wh: Warehouse, late: int = ON_TIME_MINUTES) -> DataFrame:
    """Always two rows, Weather and Mechanical (a flight may be in both).

    One scan with conditional aggregates, unpivoted afterwards; a global
    aggregate always yields its row, so an empty cause still appears.
    """
    late_c = F.col("ArrivalDelayMin") > late
    causes = {"Weather": "WeatherImpactFlag", "Mechanical": "MechanicalDelayFlag"}
    aggs = []
    for tag, flag in causes.items():
        hit = F.col(flag) & late_c
        aggs += [
            F.count(F.when(hit, 1)).alias(f"{tag}_n"),
            F.sum(F.when(hit, F.col("ArrivalDelayMin"))).alias(f"{tag}_sd"),
            F.count(F.when(hit, F.col("ArrivalDelayMin"))).alias(f"{tag}_cd"),
            F.sum(F.when(hit, F.col("Revenue"))).alias(f"{tag}_rev"),
        ]
    one = wh.fact_flight.agg(*aggs)
    rows_ = F.array(*[
        F.struct(F.lit(tag).alias("DelayType"),
                 F.col(f"{tag}_n").alias("FlightCount"),
                 ratio(F.col(f"{tag}_sd"), F.col(f"{tag}_cd")).alias("AvgDelayMin"),
                 F.col(f"{tag}_rev").cast("double").alias("ImpactedRevenue"))
        for tag in causes])
    return one.select(F.inline(rows_))


def aircraft_utilization(wh: Warehouse) -> DataFrame:
    """Days operated, flights and hours per tail number and model.

    Flights are reduced once, to one row per tail number, model and day, from
    which distinct days are then counted. A day rarely has many flights of an
    aircraft, so a reduction by its key before the join would only hold every
    row in a second table of the same task.
    """
    ac = dim_cols(wh, "aircraft", "AircraftKey", "TailNumber", "Model", current_only=True)
    flown = wh.fact_flight.select("AircraftKey", "DateKey", "AirTimeMin", "LoadFactor")
    by_day = flown.join(ac, "AircraftKey").groupBy("TailNumber", "Model", "DateKey").agg(
        rows().alias("n"), F.sum("AirTimeMin").alias("air"),
        F.sum("LoadFactor").alias("lf"), F.count("LoadFactor").alias("lf_n"))
    return (by_day.groupBy("TailNumber", "Model").agg(
                F.count("DateKey").alias("DaysOperated"),
                int_sum("n").alias("TotalFlights"),
                (F.sum("air").cast("double") / 60.0).alias("TotalFlightHours"),
                weighted_avg(F.col("lf"), F.col("lf_n")).alias("AvgLoadFactor"))
            .orderBy(F.col("TotalFlightHours").desc_nulls_first()))


def _calendar_fanout(wh: Warehouse, year_from: int, group: list[str], left: DataFrame,
                     right: DataFrame, corrected: bool = False) -> DataFrame:
    """Date rows LEFT JOIN two per-DateKey aggregates, with fan-out weights.

    ``left``/``right`` hold one row per DateKey with a row count ``n_l``/``n_r``.
    Under the original's two LEFT JOINs on DateKey every left row repeats
    max(n_r, 1) times and vice versa; ``w_l``/``w_r`` carry those weights
    (1 when ``corrected``: each fact counted once).
    """
    days = F.broadcast(wh.date.filter(F.col("Year") >= year_from).select("DateKey", *group))
    one = F.lit(1).cast("long")
    return (days.join(left, "DateKey", "left").join(right, "DateKey", "left")
            .withColumn("w_l", one if corrected else multiplicity("n_r"))
            .withColumn("w_r", one if corrected else multiplicity("n_l")))


def _distinct_flights(wh: Warehouse, year_from: int, group: list[str]) -> DataFrame:
    ff = with_dates(wh, wh.fact_flight, *group, year_from=year_from)
    return ff.groupBy(*group).agg(F.countDistinct("FlightFactKey").alias("_flights"))


def monthly_revenue(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF,
                    mode: str = "reference", unique_keys: bool = False) -> DataFrame:
    """Flight and cargo revenue per month from the year before ``as_of`` on.

    The original LEFT JOINs flights and cargo on the date, so each side is
    repeated once per row of the other on that day; the sums are rebuilt
    from per-day aggregates with those repetition weights.
    ``mode="corrected"``: each fact once, and a missing side counts as 0 in
    TotalRevenue instead of making it NULL.  ``unique_keys=True``
    (FlightFactKey known unique) takes TotalFlights from the per-day counts
    instead of a distinct count over the flights.
    """
    corrected = check_mode(mode)
    year_from = as_of.year - 1
    lo = year_from * 10000 + 101
    group = ["Year", "MonthName", "Month"]
    fl = restrict_dates(wh.fact_flight, lo).groupBy("DateKey").agg(
        rows().alias("n_l"), F.sum("Revenue").alias("s_l"), F.count("FlightFactKey").alias("c_l"))
    cg = restrict_dates(wh.fact_cargo, lo).groupBy("DateKey").agg(
        rows().alias("n_r"), F.sum("Revenue").alias("s_r"))
    j = _calendar_fanout(wh, year_from, group, fl, cg, corrected)
    flight_rev = F.sum(F.col("s_l") * F.col("w_l"))
    cargo_rev = F.sum(F.col("s_r") * F.col("w_r"))
    total = (F.coalesce(flight_rev, F.lit(0)) + F.coalesce(cargo_rev, F.lit(0))
             if corrected else flight_rev + cargo_rev)
    rev = j.groupBy(*group).agg(
        flight_rev.cast("double").alias("FlightRevenue"),
        cargo_rev.cast("double").alias("CargoRevenue"),
        total.cast("double").alias("TotalRevenue"),
        F.sum("c_l").alias("_flights"))
    if unique_keys:
        out = rev
    else:
        # Both sides have one row per calendar month: bounded by the date dimension.
        out = join_on_groups(rev.drop("_flights"), _distinct_flights(wh, year_from, group), group,
                             "left", bounded_right=True)
    return (out.withColumn("TotalFlights", F.coalesce(F.col("_flights"), F.lit(0)).cast("long"))
            .drop("_flights").orderBy("Year", "Month"))


def route_matrix(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF, days: int = 90,
                 min_flights: int = 10) -> DataFrame:
    """Frequency, revenue, RASM and OTP per airport pair (last ``days``)."""
    ff = with_dates(wh, wh.fact_flight, since=days_before(as_of, days))
    ff = airports(wh, ff, {"Origin": "IATA"}, {"Destination": "IATA"})
    return (ff.groupBy("Origin", "Destination").agg(
                rows().alias("Frequency"),
                exact_avg("LoadFactor").alias("AvgLoadFactor"),
                money_sum("Revenue").alias("TotalRevenue"),
                ratio(F.sum("Revenue"), F.sum(seat_miles()), 4, scale=2).alias("RASM"),
                pct(count_if(on_time()), rows()).alias("OTP"))
            .filter(F.col("Frequency") >= min_flights)
            .orderBy(F.col("TotalRevenue").desc_nulls_first()))


def fare_class_mix(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF, days: int = 30) -> DataFrame:
    """Bookings and revenue per cabin / class with shares of the total.

    The shares use a window over the aggregated rows (one per fare class,
    bounded by the dimension), never over booking rows.
    """
    fb = with_dates(wh, wh.fact_booking.filter(~F.col("CancellationFlag")),
                    since=days_before(as_of, days))
    fb = fb.join(dim_cols(wh, "fare_class", "FareClassKey", "CabinClass", "ClassName"),
                 "FareClassKey")
    agg = fb.groupBy("CabinClass", "ClassName").agg(
        rows().alias("Bookings"),
        F.sum("TotalAmount").alias("_rev"),
        exact_avg("TicketPrice").alias("AvgFare"))
    everything = Window.partitionBy()
    return (agg.select(
                "CabinClass", "ClassName", "Bookings",
                F.col("_rev").cast("double").alias("Revenue"), "AvgFare",
                pct(F.col("Bookings"), F.sum("Bookings").over(everything)).alias("BookingShare"),
                pct(F.col("_rev"), F.sum("_rev").over(everything), scale=2).alias("RevenueShare"))
            .orderBy(F.col("Revenue").desc_nulls_first()))


def route_profitability(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF, days: int = 90,
                        min_flights: int = 5, mode: str = "reference") -> DataFrame:
    """Profit per city-pair route and carrier, last ``days`` (cancelled included)."""
    ff = with_dates(wh, wh.fact_flight, since=days_before(as_of, days))
    ff = carriers(wh, airports(wh, scheduled(wh, ff), {"DepartureCity": "City"},
                               {"ArrivalCity": "City"}))
    names = dict(flights="Flights", revenue="Revenue", costs="Costs", profit="Profit")
    return profitability(ff, names, min_flights, with_load_factor=False, mode=mode)


def cost_breakdown(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF,
                   mode: str = "reference") -> DataFrame:
    """Flight and maintenance costs per quarter (fan-out on the date).

    ``mode="corrected"``: each fact once, missing cost parts count as 0.
    """
    corrected = check_mode(mode)
    year_from = as_of.year - 1
    lo = year_from * 10000 + 101
    group = ["Year", "Quarter"]
    fl = restrict_dates(wh.fact_flight, lo).groupBy("DateKey").agg(
        rows().alias("n_l"), F.sum("FuelCost").alias("fuel"), F.sum("CrewCost").alias("crew"),
        F.sum("AirportFees").alias("fees"), F.sum(flight_costs(mode=mode)).alias("costs"))
    mt = restrict_dates(wh.fact_maintenance, lo).groupBy("DateKey").agg(
        rows().alias("n_r"), F.sum("TotalCost").alias("maint"))
    j = _calendar_fanout(wh, year_from, group, fl, mt, corrected)
    wl, wr = F.col("w_l"), F.col("w_r")
    flight_cost, maint_cost = F.sum(F.col("costs") * wl), F.sum(F.col("maint") * wr)
    if corrected:
        flight_cost, maint_cost = (F.coalesce(flight_cost, F.lit(0)),
                                   F.coalesce(maint_cost, F.lit(0)))
    return (j.groupBy(*group).agg(
                money_sum(F.col("fuel") * wl).alias("FuelCost"),
                money_sum(F.col("crew") * wl).alias("CrewCost"),
                money_sum(F.col("fees") * wl).alias("AirportFees"),
                money_sum(F.col("maint") * wr).alias("MaintenanceCost"),
                (flight_cost + maint_cost).cast("double").alias("TotalCost"))
            .orderBy(*group))


def maintenance_impact(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF, days: int = 180) -> DataFrame:
    """Maintenance events and cost per manufacturer and model (last ``days``).

    Maintenance rows are reduced to one row per aircraft before the join
    with the aircraft dimension.
    """
    fm = with_dates(wh, wh.fact_maintenance, since=days_before(as_of, days))
    per_ac = fm.groupBy("AircraftKey").agg(
        rows().alias("n"), F.sum("TotalCost").alias("cost"), F.count("TotalCost").alias("cost_n"),
        F.sum("DowntimeHours").alias("down"), F.sum("FlightsAffected").alias("fa"))
    ac = dim_cols(wh, "aircraft", "AircraftKey", "Manufacturer", "Model", current_only=True)
    return (per_ac.join(ac, "AircraftKey").groupBy("Manufacturer", "Model").agg(
                int_sum("n").alias("MaintenanceEvents"),
                money_sum("cost").alias("TotalCost"),
                money_sum("down").alias("TotalDowntime"),
                int_sum("fa").alias("FlightsAffected"),
                weighted_avg(F.col("cost"), F.col("cost_n")).alias("AvgCostPerEvent"))
            .orderBy(F.col("TotalCost").desc_nulls_first()))


def loyalty_performance(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF, days: int = 365,
                        mode: str = "reference") -> DataFrame:
    """Customers, bookings and revenue per tier for the last ``days``.

    As in the original, customers without any booking stay (with zero
    bookings) while customers whose bookings are all older vanish.  The
    cut-off is the first DateKey on or after ``as_of - days`` (the intent of
    the original's unordered ``LIMIT 1``), read as a scalar subquery.
    ``mode="corrected"`` applies the date condition inside the join, so
    customers whose bookings are all older stay with zero bookings.
    """
    corrected = check_mode(mode)
    cutoff = (wh.date.filter(F.col("Date") >= F.lit(days_before(as_of, days)))
              .select(F.min("DateKey")).scalar())
    # The cut-off subquery is referenced once; the flag is reused below.
    fb = wh.fact_booking.withColumn("__kept", F.col("DateKey").isNull() | (F.col("DateKey") >= cutoff))
    kept = F.col("__kept")
    per_c = fb.groupBy("CustomerKey").agg(
        rows().alias("n_all"),
        count_if(kept).alias("n_kept"),
        F.count(F.when(kept, F.col("BookingKey"))).alias("bk"),
        F.sum(F.when(kept, F.col("TotalAmount"))).alias("amt"),
        F.count(F.when(kept, F.col("TotalAmount"))).alias("amt_n"))
    cust = dim_cols(wh, "customer", "CustomerKey", "LoyaltyTier", current_only=True)
    j = cust.join(per_c, "CustomerKey", "left")
    if not corrected:
        j = j.filter(F.col("n_all").isNull() | (F.col("n_kept") > 0))
    bookings = F.sum(F.coalesce(F.col("bk"), F.lit(0)))
    return (j.groupBy("LoyaltyTier").agg(
                F.countDistinct("CustomerKey").alias("Customers"),
                bookings.cast("long").alias("Bookings"),
                money_sum("amt").alias("Revenue"),
                ratio(F.sum("amt"), F.sum("amt_n")).alias("AvgBookingValue"),
                ratio(bookings, F.countDistinct("CustomerKey"), 2).alias("BookingsPerCustomer"))
            .orderBy(F.col("Revenue").desc_nulls_first()))


def customer_retention(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF,
                       mode: str = "reference") -> DataFrame:
    """Active and returning customers per quarter since last year.

    Returning = has any booking before the first day of ``as_of``'s year (one
    fixed cut-off for every quarter, as in the original).  With
    ``mode="corrected"``: any booking before the first day of *that* quarter,
    from each customer's first booking key.
    """
    active = (with_dates(wh, wh.fact_booking, "Year", "Quarter", year_from=as_of.year - 1)
              .select("Year", "Quarter", "CustomerKey").distinct())
    if check_mode(mode):
        first = wh.fact_booking.groupBy("CustomerKey").agg(F.min("DateKey").alias("_first"))
        quarter_start = F.col("Year") * 10000 + ((F.col("Quarter") - 1) * 3 + 1) * 100 + 1
        j = (active.join(first, "CustomerKey", "left")
             .withColumn("_ret", F.col("_first") < quarter_start))
    else:
        cutoff = wh.date.filter(F.col("Year") == as_of.year).select(F.min("DateKey")).scalar()
        returning = (wh.fact_booking.filter(F.col("DateKey") < cutoff)
                     .select("CustomerKey").distinct().withColumn("_ret", F.lit(True)))
        j = active.join(returning, "CustomerKey", "left")
    ret = F.count(F.when(F.col("_ret"), F.col("CustomerKey")))
    return (j.groupBy("Year", "Quarter").agg(
                F.count("CustomerKey").alias("ActiveCustomers"),
                ret.alias("ReturningCustomers"),
                pct(ret, F.count("CustomerKey")).alias("RetentionRate"))
            .orderBy("Year", "Quarter"))


def executive_kpis(wh: Warehouse, as_of: dt.date = DEFAULT_AS_OF, days: int = 30,
                   mode: str = "reference", unique_keys: bool = False) -> DataFrame:
    """One KPI row for the last ``days``.

    The original LEFT JOINs bookings to flights on the schedule key only, so
    every flight row repeats once per booking of its FlightKey.  Bookings are
    counted per FlightKey and applied as a weight; the distinct customer and
    booking counts come from the bookings of the flights in the window.
    ``mode="corrected"`` weighs every flight once.  ``unique_keys=True``
    (FlightFactKey and BookingKey known unique) counts flights and bookings
    instead of de-duplicating them; customers are always counted distinct.
    """
    corrected = check_mode(mode)
    ff = with_dates(wh, wh.fact_flight, since=days_before(as_of, days))
    per_fk = wh.fact_booking.groupBy("FlightKey").agg(rows().alias("n_b"))
    j = ff.join(per_fk, "FlightKey", "left").withColumn(
        "w", F.lit(1).cast("long") if corrected else multiplicity("n_b"))
    w = F.col("w")
    flown = ff.select("FlightKey").distinct()
    bk = wh.fact_booking.join(flown, "FlightKey", "left_semi")
    # Both distinct counts in one scan of the bookings, as one scalar struct.
    n_bookings = F.count("BookingKey") if unique_keys else F.countDistinct("BookingKey")
    counts = bk.select(F.struct(F.countDistinct("CustomerKey").alias("c"),
                                n_bookings.alias("b"))).scalar()
    return j.agg(
        F.lit("Last 30 Days" if days == 30 else f"Last {days} Days").alias("Period"),
        (F.count("FlightFactKey") if unique_keys else F.countDistinct("FlightFactKey"))
        .alias("TotalFlights"),
        pct(F.sum(F.when(on_time(), w).otherwise(0)), F.sum(w)).alias("OnTimePerformance"),
        ratio(F.sum(F.col("LoadFactor") * w),
              F.sum(F.when(F.col("LoadFactor").isNotNull(), w)), 2, scale=2).alias("AvgLoadFactor"),
        money_sum(F.col("Revenue") * w).alias("TotalRevenue"),
        ratio(F.sum(F.col("Revenue") * w), F.sum(seat_miles() * w), 4, scale=2).alias("RASM"),
    ).select("*", counts.alias("__bk")).select(
        "*", F.col("__bk.c").alias("ActiveCustomers"), F.col("__bk.b").alias("TotalBookings")
    ).drop("__bk")
