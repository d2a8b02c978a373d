"""Oracle SQL texts (DuckDB dialect), one per report job.

Most texts work in two steps: a fact is first totalled over its own keys
("cells"), then the cells get their labels and are totalled again.  Only the
five jobs whose result depends on a many-to-many join (maintenance
reliability, aircraft utilisation mart, monthly revenue, cost breakdown,
executive KPIs) join the facts row by row.  Counts are BIGINT, money sums
DOUBLE of the exact sum, averages exact sum / count, rounding comes last.
"""

from __future__ import annotations

import datetime as dt

from aerostar.functions.dates import DEFAULT_AS_OF, DEFAULT_YEAR
from aerostar.oracle.prelude import with_prelude

AS_OF = DEFAULT_AS_OF
YEAR = DEFAULT_YEAR


def first_day(days: int, as_of: dt.date = AS_OF) -> dt.date:
    """First day of a window that ends ``days`` after it on ``as_of``."""
    return as_of - dt.timedelta(days=days)


def within(days: int) -> str:
    """Calendar condition of a window."""
    return f"Date >= DATE '{first_day(days).isoformat()}'"


def cnt_if(cond: str) -> str:
    return f"COUNT(*) FILTER (WHERE {cond})"


def total(expr: str) -> str:
    return f"CAST(SUM({expr}) AS BIGINT)"


def money(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DOUBLE)"


def div(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def avg(expr: str) -> str:
    return div(f"SUM({expr})", f"COUNT({expr})")


def rnd(num: str, den: str, digits: int) -> str:
    """num / den of integral values, rounded half away from zero in whole numbers.

    floor((2 * |num| * 10^digits + |den|) / (2 * |den|)) counts units of the last digit.
    """
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    units = f"((2 * {10 ** digits} * ABS({n}) + ABS({d})) // NULLIF(2 * ABS({d}), 0))"
    return f"(CAST(SIGN({n}) * SIGN({d}) * {units} AS DOUBLE) / 1e{digits})"


def pct(num: str, den: str, digits: int = 2, scale: int = 0) -> str:
    """Percentage of two values with ``scale`` decimals each."""
    k = 10 ** scale
    return rnd(f"({num}) * {100 * k}", f"({den}) * {k}", digits)


# Cells -----------------------------------------------------------------------

#: What a cell of flights holds; "x_n" counts the non-null values summed in "x".
_FLIGHT_PARTS = {
    "n": "COUNT(*)",
    "punctual": cnt_if("ArrivalDelayMin <= 15"),
    "cancelled": cnt_if("CancellationFlag"),
    "weather": cnt_if("WeatherImpactFlag"),
    "mechanical": cnt_if("MechanicalDelayFlag"),
    "filled": "SUM(SeatsFilled)",
    "offered": "SUM(SeatsAvailable)",
    "earned": "SUM(Revenue)",
    "spent": "SUM(FuelCost + CrewCost + AirportFees)",
    "seat_miles": "SUM(CAST(SeatsAvailable AS BIGINT) * DistanceMiles)",
    "load": "SUM(LoadFactor)", "load_n": "COUNT(LoadFactor)",
    "late": "SUM(ArrivalDelayMin)", "late_n": "COUNT(ArrivalDelayMin)",
    "out_late": "SUM(DepartureDelayMin)", "out_late_n": "COUNT(DepartureDelayMin)",
    "miles": "SUM(DistanceMiles)", "miles_n": "COUNT(DistanceMiles)",
}
_ROUTE = "DepartureAirportKey, ArrivalAirportKey"
_LIVE = "NOT CancellationFlag"
_DATED = "FactFlight JOIN DimDate USING (DateKey)"
_ENDS = ("JOIN DimAirport o ON o.AirportKey = cell.DepartureAirportKey "
         "JOIN DimAirport t ON t.AirportKey = cell.ArrivalAirportKey")
_SCHEDULED = "FlightKey IN (SELECT FlightKey FROM DimFlight)"


def flight_cells(keys: str, keep: str = "TRUE", rows: str = _DATED) -> str:
    """CTE ``cell``: flights totalled over ``keys``."""
    parts = ", ".join(f"{e} AS {name}" for name, e in _FLIGHT_PARTS.items())
    return f"cell AS (SELECT {keys}, {parts} FROM {rows} WHERE {keep} GROUP BY {keys})"


def mean(part: str) -> str:
    return div(f"SUM({part})", f"SUM({part}_n)")


def mean2(part: str) -> str:
    """Average of a part with two decimals, rounded to two decimals."""
    return rnd(f"SUM({part}) * 100", f"SUM({part}_n) * 100", 2)


PUNCTUALITY = pct("SUM(punctual)", "SUM(n)")
PER_SEAT_MILE = rnd("SUM(earned) * 100", "SUM(seat_miles) * 100", 4)
MARGIN = pct("SUM(earned) - SUM(spent)", "SUM(earned)", 2, 2)
PROFIT = "CAST(SUM(earned) - SUM(spent) AS DOUBLE)"

TEXTS: dict[str, str] = {}


def text(name: str, body: str, *ctes: str) -> None:
    TEXTS[name] = with_prelude(body, ",\n".join(ctes))


# Flights by route, carrier and time ------------------------------------------

text("otp_by_route", f"""
SELECT o.IATA AS DepartureAirport, t.IATA AS ArrivalAirport, CarrierName,
       {mean("late")} AS AvgArrivalDelay, {mean("out_late")} AS AvgDepartureDelay,
       {total("n")} AS TotalFlights, {total("punctual")} AS OnTimeFlights,
       {PUNCTUALITY} AS OnTimePercentage
FROM cell {_ENDS} JOIN DimCarrier USING (CarrierKey)
GROUP BY ALL HAVING SUM(n) >= 10
""", flight_cells(f"{_ROUTE}, CarrierKey", f"Year = {YEAR} AND {_LIVE} AND {_SCHEDULED}"))

text("rasm_by_route", f"""
SELECT Year, Quarter, o.City AS DepartureCity, t.City AS ArrivalCity,
       {PER_SEAT_MILE} AS RASM, {total("seat_miles")} AS AvailableSeatMiles,
       {money("earned")} AS TotalRevenue, {mean("load")} AS AvgLoadFactor
FROM cell {_ENDS}
GROUP BY ALL
""", flight_cells(f"{_ROUTE}, Year, Quarter", f"Year >= {YEAR - 1}"))

text("weather_impact", f"""
SELECT City AS Airport, Severity, WeatherCondition,
       {total("cancelled")} AS Cancellations, {mean("late")} AS AvgDelay,
       {money("earned")} AS LostRevenue, {total("n")} AS AffectedFlights
FROM cell JOIN DimAirport ON AirportKey = DepartureAirportKey JOIN DimWeather USING (WeatherKey)
GROUP BY ALL
""", flight_cells("DepartureAirportKey, WeatherKey", f"WeatherImpactFlag AND Year = {YEAR}"))

text("route_profitability_annual", f"""
SELECT CarrierName, concat_ws(' - ', o.City, t.City) AS Route, {MARGIN} AS ProfitMargin,
       {PROFIT} AS NetProfit, {money("spent")} AS TotalCosts, {money("earned")} AS TotalRevenue,
       {total("n")} AS TotalFlights, {mean("load")} AS AvgLoadFactor
FROM cell {_ENDS} JOIN DimCarrier USING (CarrierKey)
GROUP BY ALL HAVING SUM(n) >= 20
""", flight_cells(f"{_ROUTE}, CarrierKey", f"Year = {YEAR} AND {_LIVE} AND {_SCHEDULED}"))

text("route_profitability", f"""
SELECT CarrierName, concat_ws(' - ', o.City, t.City) AS Route, {MARGIN} AS ProfitMargin,
       {PROFIT} AS Profit, {money("spent")} AS Costs, {money("earned")} AS Revenue,
       {total("n")} AS Flights
FROM cell {_ENDS} JOIN DimCarrier USING (CarrierKey)
GROUP BY ALL HAVING SUM(n) >= 5
""", flight_cells(f"{_ROUTE}, CarrierKey", f"{within(90)} AND {_SCHEDULED}"))

text("route_matrix", f"""
SELECT o.IATA AS Origin, t.IATA AS Destination, {total("n")} AS Frequency, {PUNCTUALITY} AS OTP,
       {PER_SEAT_MILE} AS RASM, {money("earned")} AS TotalRevenue, {mean("load")} AS AvgLoadFactor
FROM cell {_ENDS}
GROUP BY ALL HAVING SUM(n) >= 10
""", flight_cells(_ROUTE, within(90)))

text("route_performance", f"""
SELECT o.IATA AS OriginIATA, o.City AS OriginCity, t.IATA AS DestinationIATA, t.City AS DestinationCity,
       CarrierName, {total("n")} AS TotalFlights, {PUNCTUALITY} AS OTP, {PER_SEAT_MILE} AS RASM,
       {mean("miles")} AS AvgDistance, {mean("late")} AS AvgDelay, {mean("load")} AS AvgLoadFactor,
       {money("earned")} AS TotalRevenue
FROM cell {_ENDS} JOIN DimCarrier USING (CarrierKey)
GROUP BY ALL HAVING SUM(n) >= 10
""", flight_cells(f"{_ROUTE}, CarrierKey", rows="FactFlight"))

text("otp_top_routes", f"""
SELECT concat_ws(' - ', o.City, t.City) AS Route, CarrierName,
       {PUNCTUALITY} AS OnTimePercentage, {total("n")} AS TotalFlights
FROM cell {_ENDS} JOIN DimCarrier USING (CarrierKey)
GROUP BY ALL
ORDER BY OnTimePercentage DESC NULLS FIRST, Route, CarrierName LIMIT 20
""", flight_cells(f"{_ROUTE}, CarrierKey", rows="FactFlight"))

text("top_routes_by_revenue", f"""
SELECT concat_ws(' → ', o.City, t.City) AS Route, {total("n")} AS FlightCount,
       {money("earned")} AS TotalRevenue
FROM cell {_ENDS}
GROUP BY ALL
ORDER BY TotalRevenue DESC NULLS FIRST, Route LIMIT 10
""", flight_cells(_ROUTE, rows="FactFlight"))

text("delay_causes_monthly", f"""
SELECT Year, MonthName, {total("weather")} AS WeatherDelays, {total("mechanical")} AS MechanicalDelays,
       {total("n")} AS TotalDelayedFlights, {money("earned")} AS ImpactedRevenue,
       {mean("late")} AS AvgDelayMinutes
FROM cell GROUP BY ALL
""", flight_cells("Year, MonthName", f"Year = {YEAR} AND ArrivalDelayMin > 15"))

text("delay_causes", f"""
SELECT DelayType, COUNT(FlightFactKey) AS FlightCount, {money("Revenue")} AS ImpactedRevenue,
       {avg("ArrivalDelayMin")} AS AvgDelayMin
FROM (VALUES ('Weather'), ('Mechanical')) cause(DelayType)
LEFT JOIN tardy ON CASE DelayType WHEN 'Weather' THEN WeatherImpactFlag ELSE MechanicalDelayFlag END
GROUP BY DelayType
""", "tardy AS (SELECT * FROM FactFlight WHERE ArrivalDelayMin > 15)")

text("capacity_trends", f"""
SELECT CarrierName, Year, MonthName, {pct("SUM(filled)", "SUM(offered)")} AS OverallLoadFactor,
       {total("filled")} AS TotalSeatsFilled, {total("offered")} AS TotalSeatsAvailable,
       {money("earned")} AS TotalRevenue, {total("n")} AS TotalFlights
FROM cell JOIN DimCarrier USING (CarrierKey)
GROUP BY ALL
""", flight_cells("CarrierKey, Year, MonthName", f"Year = {YEAR}"))

text("monthly_flight_summary", f"""
SELECT CarrierName, Year, Month, MonthName, {PUNCTUALITY} AS OTP, {total("punctual")} AS OnTimeFlights,
       {total("cancelled")} AS Cancellations, {total("n")} AS TotalFlights,
       {total("filled")} AS TotalPassengers, {total("offered")} AS TotalSeats,
       {mean2("load")} AS AvgLoadFactor, {money("spent")} AS TotalCosts, {money("earned")} AS TotalRevenue
FROM cell JOIN DimCarrier USING (CarrierKey)
GROUP BY ALL
""", flight_cells("CarrierKey, Year, Month, MonthName"))

text("daily_operations", f"""
SELECT Date, DayOfWeek, IsWeekend, {total("weather")} AS WeatherDelays,
       {total("mechanical")} AS MechanicalDelays, {total("cancelled")} AS Cancellations,
       {total("n")} AS TotalFlights, {total("punctual")} AS OnTimeFlights, {PUNCTUALITY} AS OTP,
       {mean("late")} AS AvgDelay, {mean("load")} AS AvgLoadFactor,
       {total("filled")} AS TotalPassengers, {money("earned")} AS TotalRevenue
FROM cell JOIN DimDate USING (DateKey)
WHERE {within(90)} GROUP BY ALL
""", flight_cells("DateKey", rows="FactFlight"))

text("daily_otp", f"""
SELECT Date, {PUNCTUALITY} AS OTP, {total("punctual")} AS OnTimeFlights, {total("n")} AS TotalFlights,
       {mean("late")} AS AvgDelay
FROM cell JOIN DimDate USING (DateKey)
WHERE {within(30)} GROUP BY ALL
""", flight_cells("DateKey", _LIVE, "FactFlight"))

text("kpi_overview", f"""
SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS TotalFlights, {PUNCTUALITY} AS OnTimePercentage,
       {mean2("load")} AS AvgLoadFactor, {rnd("SUM(late)", "SUM(late_n)", 2)} AS AvgDelayMinutes
FROM cell
""", flight_cells("CarrierKey", _LIVE, "FactFlight"))

# Cargo, aircraft and maintenance ---------------------------------------------

text("cargo_performance", f"""
SELECT Year, Quarter, o.City AS Origin, t.City AS Destination,
       {pct("SUM(in_time)", "SUM(n)")} AS OnTimeDeliveryRate,
       {rnd("SUM(per_kg) * 1000000000", "SUM(per_kg_n) * 1000000000", 6)} AS RevenuePerKg,
       {money("kg")} AS TotalWeightKg, {money("earned")} AS TotalRevenue, {total("n")} AS TotalShipments
FROM cell {_ENDS}
GROUP BY ALL
""", """shipment AS (
  SELECT *, CAST(CAST(Revenue AS DOUBLE) / NULLIF(CAST(WeightKg AS DOUBLE), 0) AS DECIMAL(38,9)) AS per_kg
  FROM FactCargo)""", f"""cell AS (
  SELECT {_ROUTE}, Year, Quarter, COUNT(*) AS n, {cnt_if("OnTimeDeliveryFlag")} AS in_time,
         SUM(WeightKg) AS kg, SUM(Revenue) AS earned, SUM(per_kg) AS per_kg, COUNT(per_kg) AS per_kg_n
  FROM shipment JOIN DimDate USING (DateKey) WHERE Year >= {YEAR - 1}
  GROUP BY {_ROUTE}, Year, Quarter)""")

_FLEET = "craft AS (SELECT * FROM DimAircraft WHERE IsCurrent)"

text("aircraft_utilization", f"""
SELECT Model, TailNumber, {div("SUM(minutes)", "60")} AS TotalFlightHours,
       COUNT(DISTINCT DateKey) AS DaysOperated, {total("n")} AS TotalFlights, {mean("load")} AS AvgLoadFactor
FROM craft JOIN day_cell USING (AircraftKey)
GROUP BY ALL
""", _FLEET, """day_cell AS (
  SELECT AircraftKey, DateKey, COUNT(*) AS n, SUM(AirTimeMin) AS minutes,
         SUM(LoadFactor) AS load, COUNT(LoadFactor) AS load_n
  FROM FactFlight GROUP BY AircraftKey, DateKey)""")

text("maintenance_impact", f"""
SELECT Model, Manufacturer, {total("n")} AS MaintenanceEvents, {total("hit")} AS FlightsAffected,
       {money("cost")} AS TotalCost, {mean("cost")} AS AvgCostPerEvent, {money("hours")} AS TotalDowntime
FROM craft JOIN shop USING (AircraftKey)
GROUP BY ALL
""", _FLEET, f"""shop AS (
  SELECT AircraftKey, COUNT(*) AS n, SUM(FlightsAffected) AS hit, SUM(TotalCost) AS cost,
         COUNT(TotalCost) AS cost_n, SUM(DowntimeHours) AS hours
  FROM FactMaintenance WHERE DateKey IN (SELECT DateKey FROM DimDate WHERE {within(180)})
  GROUP BY AircraftKey)""")

text("maintenance_reliability", f"""
SELECT Age, Model, Manufacturer, {total("FlightsAffected")} AS TotalFlightsAffected,
       {money("DowntimeHours")} AS TotalDowntimeHours, {money("TotalCost")} AS TotalMaintenanceCost,
       {avg("TotalCost")} AS AvgCostPerEvent, COUNT(DISTINCT MaintenanceKey) AS MaintenanceEvents,
       {div("SUM(TotalCost)", "COUNT(DISTINCT FlightFactKey)")} AS CostPerFlightHour
FROM visit LEFT JOIN (SELECT AircraftKey, FlightFactKey FROM FactFlight) flown USING (AircraftKey)
GROUP BY ALL
""", _FLEET, """visit AS (
  SELECT AircraftKey, Age, Model, Manufacturer, MaintenanceKey, TotalCost, DowntimeHours, FlightsAffected
  FROM FactMaintenance JOIN craft USING (AircraftKey))""")

text("aircraft_utilization_mart", f"""
SELECT AircraftKey, TailNumber, Model, Manufacturer, Age,
       COUNT(MaintenanceKey) AS MaintenanceEvents, {money("TotalCost")} AS MaintenanceCosts,
       {money("DowntimeHours")} AS TotalDowntime, COUNT(*) AS TotalFlights,
       COUNT(DISTINCT flown_on) AS DaysOperated, {div("SUM(AirTimeMin)", "60")} AS TotalFlightHours,
       {avg("LoadFactor")} AS AvgLoadFactor, {money("Revenue")} AS TotalRevenue
FROM craft
LEFT JOIN (SELECT AircraftKey, DateKey AS flown_on, AirTimeMin, LoadFactor, Revenue FROM FactFlight) flown
  USING (AircraftKey)
LEFT JOIN (SELECT AircraftKey, MaintenanceKey, TotalCost, DowntimeHours FROM FactMaintenance) shop
  USING (AircraftKey)
GROUP BY ALL
""", _FLEET)

_DAYS = f"day AS (SELECT * FROM DimDate WHERE Year >= {AS_OF.year - 1})"

text("monthly_revenue", f"""
SELECT Year, Month, MonthName, COUNT(DISTINCT FlightFactKey) AS TotalFlights,
       CAST(SUM(seat_income) + SUM(hold_income) AS DOUBLE) AS TotalRevenue,
       {money("hold_income")} AS CargoRevenue, {money("seat_income")} AS FlightRevenue
FROM day
LEFT JOIN (SELECT DateKey, FlightFactKey, Revenue AS seat_income FROM FactFlight) flown USING (DateKey)
LEFT JOIN (SELECT DateKey, Revenue AS hold_income FROM FactCargo) freight USING (DateKey)
GROUP BY ALL
""", _DAYS)

text("cost_breakdown", f"""
SELECT Year, Quarter, {money("repair")} AS MaintenanceCost, {money("AirportFees")} AS AirportFees,
       {money("CrewCost")} AS CrewCost, {money("FuelCost")} AS FuelCost,
       CAST(SUM(FuelCost + CrewCost + AirportFees) + SUM(repair) AS DOUBLE) AS TotalCost
FROM day
LEFT JOIN (SELECT DateKey, FuelCost, CrewCost, AirportFees FROM FactFlight) flown USING (DateKey)
LEFT JOIN (SELECT DateKey, TotalCost AS repair FROM FactMaintenance) shop USING (DateKey)
GROUP BY ALL
""", _DAYS)

text("executive_kpis", f"""
SELECT 'Last 30 Days' AS Period, COUNT(DISTINCT BookingKey) AS TotalBookings,
       COUNT(DISTINCT CustomerKey) AS ActiveCustomers, COUNT(DISTINCT FlightFactKey) AS TotalFlights,
       {pct(cnt_if("ArrivalDelayMin <= 15"), "COUNT(*)")} AS OnTimePerformance,
       {rnd("SUM(Revenue) * 100", "SUM(CAST(SeatsAvailable AS BIGINT) * DistanceMiles) * 100", 4)} AS RASM,
       {rnd("SUM(LoadFactor) * 100", "COUNT(LoadFactor) * 100", 2)} AS AvgLoadFactor,
       {money("Revenue")} AS TotalRevenue
FROM recent
LEFT JOIN (SELECT FlightKey, BookingKey, CustomerKey FROM FactBooking) sold USING (FlightKey)
""", f"""recent AS (
  SELECT * FROM FactFlight WHERE DateKey IN (SELECT DateKey FROM DimDate WHERE {within(30)}))""")

# Bookings and customers ------------------------------------------------------

text("fare_class_yield", f"""
SELECT CabinClass, ClassName, Year, MonthName, {avg("TicketPrice")} AS AvgTicketPrice,
       {div("SUM(TotalAmount)", "COUNT(DISTINCT BookingKey)")} AS YieldPerBooking,
       {money("TotalAmount")} AS TotalRevenue, COUNT(DISTINCT BookingKey) AS TotalBookings
FROM sold JOIN DimFareClass USING (FareClassKey)
GROUP BY ALL
""", f"""sold AS (
  SELECT FareClassKey, BookingKey, TicketPrice, TotalAmount, Year, MonthName
  FROM FactBooking JOIN DimDate USING (DateKey) WHERE Year = {YEAR} AND {_LIVE})""")

text("fare_class_mix", f"""
SELECT ClassName, CabinClass, CAST(n AS BIGINT) AS Bookings, CAST(amount AS DOUBLE) AS Revenue,
       {div("price", "price_n")} AS AvgFare,
       {pct("n", "(SELECT SUM(n) FROM class_cell)")} AS BookingShare,
       {pct("amount", "(SELECT SUM(amount) FROM class_cell)", 2, 2)} AS RevenueShare
FROM class_cell
""", f"""key_cell AS (
  SELECT FareClassKey, COUNT(*) AS n, SUM(TotalAmount) AS amount, SUM(TicketPrice) AS price,
         COUNT(TicketPrice) AS price_n
  FROM FactBooking WHERE {_LIVE} AND DateKey IN (SELECT DateKey FROM DimDate WHERE {within(30)})
  GROUP BY FareClassKey)""", """class_cell AS (
  SELECT ClassName, CabinClass, SUM(n) AS n, SUM(amount) AS amount, SUM(price) AS price,
         SUM(price_n) AS price_n
  FROM key_cell JOIN DimFareClass USING (FareClassKey) GROUP BY ALL)""")


def buyer_cells(keep: str = "TRUE") -> str:
    """CTE ``buyer``: the bookings of each customer; what ``keep`` excludes counts in all_n only."""
    return f"""buyer AS (
  SELECT CustomerKey, COUNT(*) AS all_n, COUNT(*) FILTER (WHERE {keep}) AS kept_n,
         COUNT(BookingKey) FILTER (WHERE {keep}) AS n, SUM(TotalAmount) FILTER (WHERE {keep}) AS amount,
         COUNT(TotalAmount) FILTER (WHERE {keep}) AS amount_n, SUM(LoyaltyPointsEarned) AS points_in,
         SUM(LoyaltyPointsRedeemed) AS points_out, {cnt_if("CancellationFlag")} AS cancelled,
         MIN(BookingDate) AS first_day, MAX(BookingDate) AS last_day, MIN(DateKey) AS first_key
  FROM FactBooking GROUP BY CustomerKey)"""


text("customer_loyalty", f"""
SELECT LoyaltyTier, {pct("SUM(cancelled)", "SUM(n)")} AS CancellationRate,
       {total("points_out")} AS TotalPointsRedeemed, {total("points_in")} AS TotalPointsEarned,
       {mean("amount")} AS AvgRevenuePerBooking, {money("amount")} AS TotalRevenue,
       {total("n")} AS TotalBookings, COUNT(*) AS TotalCustomers
FROM buyer JOIN DimCustomer USING (CustomerKey)
WHERE IsCurrent GROUP BY LoyaltyTier
""", buyer_cells())

text("customer_ltv", f"""
SELECT CustomerKey, LoyaltyTier, CustomerID, first_day AS FirstBooking, last_day AS LastBooking,
       CAST(last_day - first_day AS BIGINT) AS CustomerTenureDays,
       COALESCE(n, 0) AS TotalBookings, COALESCE(cancelled, 0) AS Cancellations,
       {pct("cancelled", "n")} AS CancellationRate, CAST(points_in AS BIGINT) AS TotalPointsEarned,
       CAST(amount AS DOUBLE) AS LifetimeRevenue, {div("amount", "amount_n")} AS AvgBookingValue
FROM DimCustomer LEFT JOIN buyer USING (CustomerKey)
WHERE IsCurrent
""", buyer_cells())

_WINDOW_KEY = f"{first_day(365):%Y%m%d}"

text("loyalty_performance", f"""
SELECT LoyaltyTier, {rnd("COALESCE(SUM(n), 0)", "COUNT(*)", 2)} AS BookingsPerCustomer,
       {mean("amount")} AS AvgBookingValue, {money("amount")} AS Revenue,
       CAST(COALESCE(SUM(n), 0) AS BIGINT) AS Bookings, COUNT(*) AS Customers
FROM DimCustomer LEFT JOIN buyer USING (CustomerKey)
WHERE IsCurrent AND (all_n IS NULL OR kept_n > 0)
GROUP BY LoyaltyTier
""", buyer_cells(f"DateKey IS NULL OR DateKey >= {_WINDOW_KEY}"))

text("customer_retention", f"""
SELECT Year, Quarter, {pct(f"COUNT(CustomerKey) FILTER (WHERE first_key < {AS_OF.year}0101)", "COUNT(CustomerKey)")}
         AS RetentionRate,
       COUNT(CustomerKey) FILTER (WHERE first_key < {AS_OF.year}0101) AS ReturningCustomers,
       COUNT(CustomerKey) AS ActiveCustomers
FROM active LEFT JOIN buyer USING (CustomerKey)
GROUP BY ALL
""", buyer_cells(), f"""active AS (
  SELECT DISTINCT CustomerKey, Year, Quarter FROM FactBooking JOIN DimDate USING (DateKey)
  WHERE Year >= {AS_OF.year - 1})""")

# Directory, top-k and KPI reports --------------------------------------------


def counted(label: str, tables: dict[str, str], keep: str = "TRUE") -> str:
    """One row per label with the rows of its table."""
    rows = ", ".join(f"('{k}', (SELECT COUNT(*) FROM {t} WHERE {keep}))" for k, t in tables.items())
    return f"SELECT * FROM (VALUES {rows}) v({label}, Count)"


def shares(table: str, column: str, name: str) -> str:
    """Rows per value of a column; rows without a value don't count."""
    return (f"SELECT {column}, COUNT({column}) AS {name} FROM {table} "
            f"GROUP BY {column} HAVING COUNT({column}) > 0")


_KEPT = ("{0} AS (SELECT * FROM {1} WHERE IsCurrent)").format

text("current_counts", counted("Metric", {
    "Total Airports": "DimAirport", "Total Carriers": "DimCarrier",
    "Total Aircraft": "DimAircraft", "Total Customers": "DimCustomer"}, "IsCurrent"))

text("table_counts", counted("Dimension", {
    "Airports": "DimAirport", "Carriers": "DimCarrier", "Aircraft": "DimAircraft",
    "Customers": "DimCustomer", "Flights": "FactFlight"}))

text("airport_directory", """
SELECT Region, Country, City, AirportName, IATA,
       CAST(Longitude AS DOUBLE) AS Longitude, CAST(Latitude AS DOUBLE) AS Latitude
FROM port
""", _KEPT("port", "DimAirport"))

text("airports_by_region", shares("port", "Region", "Airports"), _KEPT("port", "DimAirport"))

text("fleet_directory", """
SELECT OwnershipType, Age, ManufactureYear, SeatingCapacity, AircraftType, Model, Manufacturer, TailNumber
FROM craft
""", _FLEET)

text("fleet_by_manufacturer", shares("craft", "Manufacturer", "Aircraft"), _FLEET)

text("fleet_age_histogram", """
SELECT Bin, COUNT(*) AS Aircraft,
       lo + CAST(Bin - 1 AS DOUBLE) * width AS BinStart, lo + CAST(Bin AS DOUBLE) * width AS BinEnd
FROM (SELECT lo, width,
             CAST(CASE WHEN hi = lo THEN 1
                       ELSE LEAST(20, 1 + FLOOR((Age - lo) * 20 / (hi - lo))) END AS INTEGER) AS Bin
      FROM craft, (SELECT CAST(MIN(Age) AS DOUBLE) AS lo, CAST(MAX(Age) AS DOUBLE) AS hi,
                          (CAST(MAX(Age) AS DOUBLE) - MIN(Age)) / 20.0 AS width FROM craft)
      WHERE Age IS NOT NULL)
GROUP BY Bin, lo, width
""", _FLEET)

text("fleet_summary", f"""
SELECT Model, Manufacturer, {avg("Age")} AS AvgAge, COUNT(*) AS AircraftCount FROM craft GROUP BY ALL
""", _FLEET)


def ranked(places: int) -> str:
    """CTE ``best``: the current customers with most points; ages in whole years on the report date."""
    return f"""best AS (
  SELECT *, CAST(date_sub('year', BirthDate, DATE '{AS_OF.isoformat()}') AS INTEGER) AS Years
  FROM DimCustomer WHERE IsCurrent
  QUALIFY row_number() OVER (ORDER BY LoyaltyPoints DESC NULLS FIRST, CustomerID, CustomerKey) <= {places})"""


_CARD = """SELECT LoyaltyPoints, LoyaltyTier, CustomerID, LastName, FirstName, Email, City, Country, Years AS Age
FROM best"""

text("top_customers", _CARD, ranked(100))
text("top10_customers", _CARD, ranked(10))
text("tier_distribution_top", shares("best", "LoyaltyTier", "Customers"), ranked(100))

text("loyalty_tier_summary", f"""
SELECT LoyaltyTier, {avg("LoyaltyPoints")} AS AvgPoints, COUNT(*) AS CustomerCount
FROM member GROUP BY LoyaltyTier
""", _KEPT("member", "DimCustomer"))

text("carrier_directory", "SELECT Country, AllianceCode, CarrierName, AirlineCode FROM line",
     _KEPT("line", "DimCarrier"))
text("carriers_by_alliance", shares("line", "AllianceCode", "Carriers"), _KEPT("line", "DimCarrier"))

# Data quality ----------------------------------------------------------------

#: Failing flights by check, in one pass.
_CHECKS = f"""failing AS (
  SELECT {cnt_if("FlightKey IS NULL OR FlightKey NOT IN (SELECT FlightKey FROM DimFlight)")} AS orphaned_flights,
         {cnt_if("LoadFactor NOT BETWEEN 0 AND 100")} AS invalid_load_factors,
         {cnt_if(f"DateKey IN (SELECT DateKey FROM DimDate WHERE Date > DATE '{AS_OF.isoformat()}')")} AS future_dates
  FROM FactFlight)"""

text("dq_orphaned_flights", "SELECT orphaned_flights AS Failures FROM failing", _CHECKS)
text("dq_invalid_load_factors", "SELECT invalid_load_factors AS Failures FROM failing", _CHECKS)
text("dq_future_dates", "SELECT future_dates AS Failures FROM failing", _CHECKS)
text("dq_report", """
SELECT CheckName, Failures, Failures = 0 AS Passed
FROM (UNPIVOT failing ON orphaned_flights, invalid_load_factors, future_dates
      INTO NAME CheckName VALUE Failures)
""", _CHECKS)
