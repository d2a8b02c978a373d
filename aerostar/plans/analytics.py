"""Analytics reports A01-A10 (operational, commercial and financial KPIs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.functions.dates import DEFAULT_YEAR
from aerostar.functions.measures import (ON_TIME_MINUTES, check_mode, count_if, exact_avg,
                                         flight_costs,
                                         int_sum, money_sum, on_time, pct, ratio, rows)
from aerostar.plans.common import (airports, carriers, dim_cols, join_on_groups, multiplicity,
                                   scheduled, with_dates)
from aerostar.sources.star import Warehouse


def otp_by_route(wh: Warehouse, year: int = DEFAULT_YEAR, min_flights: int = 10,
                 late: int = ON_TIME_MINUTES) -> DataFrame:
    """On-time performance per airport pair and carrier."""
    ff = with_dates(wh, wh.fact_flight.filter(~F.col("CancellationFlag")), year=year)
    ff = scheduled(wh, ff)
    ff = airports(wh, ff, {"DepartureAirport": "IATA"}, {"ArrivalAirport": "IATA"})
    ff = carriers(wh, ff)
    ok = on_time(late=late)
    return (ff.groupBy("DepartureAirport", "ArrivalAirport", "CarrierName").agg(
                rows().alias("TotalFlights"),
                count_if(ok).alias("OnTimeFlights"),
                pct(count_if(ok), rows()).alias("OnTimePercentage"),
                exact_avg("ArrivalDelayMin").alias("AvgArrivalDelay"),
                exact_avg("DepartureDelayMin").alias("AvgDepartureDelay"))
            .filter(F.col("TotalFlights") >= min_flights)
            .orderBy(F.col("OnTimePercentage").desc_nulls_first()))


def seat_miles(prefix: str = "") -> F.Column:
    return F.col(prefix + "SeatsAvailable").cast("long") * F.col(prefix + "DistanceMiles")


def rasm_by_route(wh: Warehouse, year_from: int = DEFAULT_YEAR - 1) -> DataFrame:
    """Revenue per available seat mile per city pair and quarter."""
    ff = with_dates(wh, wh.fact_flight, "Year", "Quarter", year_from=year_from)
    ff = airports(wh, ff, {"DepartureCity": "City"}, {"ArrivalCity": "City"})
    return (ff.groupBy("DepartureCity", "ArrivalCity", "Year", "Quarter").agg(
                money_sum("Revenue").alias("TotalRevenue"),
                int_sum(seat_miles()).alias("AvailableSeatMiles"),
                ratio(F.sum("Revenue"), F.sum(seat_miles()), 4, scale=2).alias("RASM"),
                exact_avg("LoadFactor").alias("AvgLoadFactor"))
            .orderBy(F.col("Year").desc_nulls_first(), F.col("Quarter").desc_nulls_first(),
                     F.col("RASM").desc_nulls_first()))


def fare_class_yield(wh: Warehouse, year: int = DEFAULT_YEAR,
                     unique_keys: bool = False) -> DataFrame:
    """Bookings and yield per fare class and month.

    The original orders by a month number it does not group by; the intent
    (group by the month number as well, then drop it) is implemented.
    ``unique_keys=True`` (BookingKey known unique, e.g. by the P15 check)
    counts bookings instead of de-duplicating them, saving a shuffle of
    (group, key) pairs.
    """
    bookings = F.count("BookingKey") if unique_keys else F.countDistinct("BookingKey")
    fb = wh.fact_booking.filter(~F.col("CancellationFlag"))
    fb = with_dates(wh, fb, "Year", "MonthName", "Month", year=year)
    fb = fb.join(dim_cols(wh, "fare_class", "FareClassKey", "ClassName", "CabinClass"),
                 "FareClassKey")
    return (fb.groupBy("ClassName", "CabinClass", "Year", "MonthName", "Month").agg(
                bookings.alias("TotalBookings"),
                money_sum("TotalAmount").alias("TotalRevenue"),
                exact_avg("TicketPrice").alias("AvgTicketPrice"),
                ratio(F.sum("TotalAmount"), bookings).alias("YieldPerBooking"))
            .orderBy("Year", "Month", F.col("TotalRevenue").desc_nulls_first())
            .drop("Month"))


def weather_impact(wh: Warehouse, year: int = DEFAULT_YEAR) -> DataFrame:
    """Weather-impacted flights per condition, severity and airport city."""
    ff = with_dates(wh, wh.fact_flight.filter(F.col("WeatherImpactFlag")), year=year)
    ff = ff.join(dim_cols(wh, "weather", "WeatherKey", "WeatherCondition", "Severity"), "WeatherKey")
    ff = ff.join(dim_cols(wh, "airport", DepartureAirportKey="AirportKey", Airport="City"),
                 "DepartureAirportKey")
    return (ff.groupBy("WeatherCondition", "Severity", "Airport").agg(
                rows().alias("AffectedFlights"),
                exact_avg("ArrivalDelayMin").alias("AvgDelay"),
                count_if(F.col("CancellationFlag")).alias("Cancellations"),
                money_sum("Revenue").alias("LostRevenue"))
            .orderBy(F.col("AffectedFlights").desc_nulls_first()))


def maintenance_reliability(wh: Warehouse, mode: str = "reference",
                            unique_keys: bool = False) -> DataFrame:
    """Maintenance cost per aircraft type.

    The original joins maintenance and flights many-to-many on the aircraft
    (every maintenance row is repeated once per flight of its aircraft).  The
    same numbers come from per-aircraft aggregates: each maintenance sum is
    weighted by max(#flights, 1) of its aircraft; no exploded join is built.
    ``mode="corrected"`` counts every maintenance row once.
    ``unique_keys=True`` (MaintenanceKey and FlightFactKey known unique)
    replaces both distinct counts by counts taken from the per-aircraft
    aggregates, so no fact-sized de-duplication shuffle remains.
    """
    corrected = check_mode(mode)
    groups = ["Manufacturer", "Model", "Age"]
    ac = dim_cols(wh, "aircraft", "AircraftKey", *groups, current_only=True)
    flights_per_ac = wh.fact_flight.groupBy("AircraftKey").agg(
        rows().alias("n_f"), F.count("FlightFactKey").alias("n_fk"))
    m = (wh.fact_maintenance.join(ac, "AircraftKey")
         .join(flights_per_ac, "AircraftKey", "left")
         .withColumn("w", F.lit(1).cast("long") if corrected else multiplicity("n_f")))
    cost_w = F.col("TotalCost") * F.col("w")
    by_type = m.groupBy(*groups).agg(
        (F.count("MaintenanceKey") if unique_keys else F.countDistinct("MaintenanceKey"))
        .alias("MaintenanceEvents"),
        money_sum(cost_w).alias("TotalMaintenanceCost"),
        ratio(F.sum(cost_w), F.sum(F.when(F.col("TotalCost").isNotNull(), F.col("w"))))
        .alias("AvgCostPerEvent"),
        money_sum(F.col("DowntimeHours") * F.col("w")).alias("TotalDowntimeHours"),
        int_sum(F.col("FlightsAffected") * F.col("w")).alias("TotalFlightsAffected"),
        F.sum(cost_w).alias("_cost"))
    # Distinct flights of the aircraft that have maintenance, per type.
    if unique_keys:
        flights = (m.select("AircraftKey", *groups, F.coalesce(F.col("n_fk"), F.lit(0)).alias("n_fk"))
                   .distinct().groupBy(*groups).agg(F.sum("n_fk").alias("_flights")))
    else:
        serviced = m.select("AircraftKey", *groups).distinct()
        flights = (wh.fact_flight.select("AircraftKey", "FlightFactKey")
                   .join(serviced, "AircraftKey")
                   .groupBy(*groups).agg(F.countDistinct("FlightFactKey").alias("_flights")))
    out = join_on_groups(by_type, flights, groups, "left")
    return (out.withColumn("CostPerFlightHour", ratio(F.col("_cost"), F.col("_flights")))
            .drop("_cost", "_flights")
            .orderBy(F.col("TotalMaintenanceCost").desc_nulls_first()))


def customer_loyalty(wh: Warehouse) -> DataFrame:
    """Bookings, revenue and points per loyalty tier (current customers).

    Bookings are first reduced to one row per customer, so the join with the
    (large) customer dimension moves customers, not bookings.
    """
    per_customer = wh.fact_booking.groupBy("CustomerKey").agg(
        F.count("BookingKey").alias("n_bk"),
        F.sum("TotalAmount").alias("s_amt"),
        F.count("TotalAmount").alias("c_amt"),
        F.sum("LoyaltyPointsEarned").alias("s_earn"),
        F.sum("LoyaltyPointsRedeemed").alias("s_redeem"),
        count_if(F.col("CancellationFlag")).alias("n_cancel"))
    cust = dim_cols(wh, "customer", "CustomerKey", "LoyaltyTier", current_only=True)
    j = cust.join(per_customer, "CustomerKey")
    return (j.groupBy("LoyaltyTier").agg(
                F.countDistinct("CustomerKey").alias("TotalCustomers"),
                int_sum("n_bk").alias("TotalBookings"),
                money_sum("s_amt").alias("TotalRevenue"),
                ratio(F.sum("s_amt"), F.sum("c_amt")).alias("AvgRevenuePerBooking"),
                int_sum("s_earn").alias("TotalPointsEarned"),
                int_sum("s_redeem").alias("TotalPointsRedeemed"),
                pct(F.sum("n_cancel"), F.sum("n_bk")).alias("CancellationRate"))
            .orderBy(F.col("TotalRevenue").desc_nulls_first()))


def route_label(sep: str = " - ") -> F.Column:
    """``dep.City || sep || arr.City`` (NULL if either city is NULL)."""
    return F.concat(F.col("DepartureCity"), F.lit(sep), F.col("ArrivalCity"))


def profitability(ff: DataFrame, names: dict[str, str], min_flights: int,
                  with_load_factor: bool, mode: str = "reference") -> DataFrame:
    costs = flight_costs(mode=mode)
    revenue, cost_sum = F.sum("Revenue"), F.sum(costs)
    aggs = [
        rows().alias(names["flights"]),
        money_sum("Revenue").alias(names["revenue"]),
        money_sum(costs).alias(names["costs"]),
        (revenue - cost_sum).cast("double").alias(names["profit"]),
        pct(revenue - cost_sum, revenue, 2, scale=2).alias("ProfitMargin"),
    ]
    if with_load_factor:
        aggs.append(exact_avg("LoadFactor").alias("AvgLoadFactor"))
    return (ff.withColumn("Route", route_label())
            .groupBy("Route", "CarrierName").agg(*aggs)
            .filter(F.col(names["flights"]) >= min_flights)
            .orderBy(F.col(names["profit"]).desc_nulls_first()))


def route_profitability_annual(wh: Warehouse, year: int = DEFAULT_YEAR,
                               min_flights: int = 20, mode: str = "reference") -> DataFrame:
    """Profit and margin per city-pair route and carrier for one year.

    ``mode="corrected"`` counts a missing cost part as 0 instead of dropping
    the flight's whole cost.
    """
    ff = with_dates(wh, wh.fact_flight.filter(~F.col("CancellationFlag")), year=year)
    ff = carriers(wh, airports(wh, scheduled(wh, ff), {"DepartureCity": "City"},
                               {"ArrivalCity": "City"}))
    names = dict(flights="TotalFlights", revenue="TotalRevenue", costs="TotalCosts",
                 profit="NetProfit")
    return profitability(ff, names, min_flights, with_load_factor=True, mode=mode)


def delay_causes_monthly(wh: Warehouse, year: int = DEFAULT_YEAR,
                         late: int = ON_TIME_MINUTES) -> DataFrame:
    """Delayed flights per month with weather / mechanical breakdown."""
    ff = wh.fact_flight.filter(F.col("ArrivalDelayMin") > late)
    ff = with_dates(wh, ff, "Year", "MonthName", "Month", year=year)
    return (ff.groupBy("Year", "MonthName", "Month").agg(
                rows().alias("TotalDelayedFlights"),
                count_if(F.col("WeatherImpactFlag")).alias("WeatherDelays"),
                count_if(F.col("MechanicalDelayFlag")).alias("MechanicalDelays"),
                exact_avg("ArrivalDelayMin").alias("AvgDelayMinutes"),
                money_sum("Revenue").alias("ImpactedRevenue"))
            .orderBy("Month").drop("Month"))


def per_kg(revenue: str = "Revenue", weight: str = "WeightKg") -> F.Column:
    """Per-row revenue / NULLIF(weight, 0), fixed to 9 decimals for an exact mean."""
    return F.try_divide(F.col(revenue).cast("double"), F.col(weight).cast("double")) \
        .cast("decimal(38,9)")


def cargo_performance(wh: Warehouse, year_from: int = DEFAULT_YEAR - 1) -> DataFrame:
    """Cargo volume, revenue and on-time delivery per city pair and quarter.

    RevenuePerKg is the mean of per-shipment ratios (zero weight excluded),
    rounded to 6 decimals.
    """
    fc = with_dates(wh, wh.fact_cargo, "Year", "Quarter", year_from=year_from)
    fc = airports(wh, fc, {"Origin": "City"}, {"Destination": "City"})
    return (fc.groupBy("Origin", "Destination", "Year", "Quarter").agg(
                rows().alias("TotalShipments"),
                money_sum("WeightKg").alias("TotalWeightKg"),
                money_sum("Revenue").alias("TotalRevenue"),
                ratio(F.sum(per_kg()), F.count(per_kg()), 6, scale=9).alias("RevenuePerKg"),
                pct(count_if(F.col("OnTimeDeliveryFlag")), rows()).alias("OnTimeDeliveryRate"))
            .orderBy(F.col("TotalRevenue").desc_nulls_first()))


def capacity_trends(wh: Warehouse, year: int = DEFAULT_YEAR) -> DataFrame:
    """A10: seats offered and filled per month and carrier."""
    ff = with_dates(wh, wh.fact_flight, "Year", "MonthName", "Month", year=year)
    ff = carriers(wh, ff)
    return (ff.groupBy("Year", "MonthName", "Month", "CarrierName").agg(
                rows().alias("TotalFlights"),
                int_sum("SeatsAvailable").alias("TotalSeatsAvailable"),
                int_sum("SeatsFilled").alias("TotalSeatsFilled"),
                pct(F.sum("SeatsFilled"), F.sum("SeatsAvailable")).alias("OverallLoadFactor"),
                money_sum("Revenue").alias("TotalRevenue"))
            .orderBy(F.col("Month"), F.col("OverallLoadFactor").desc_nulls_first())
            .drop("Month"))
