"""mode="corrected" variants against independent SQL (DuckDB) on sf0.001.

Corrected semantics (SURVEY §2.12): each fact counted once instead of the
fan-out, missing sides / cost parts as 0, V10's date condition in the join,
V11's cut-off per quarter.
"""
import pytest

from aerostar.oracle.prelude import with_prelude
from aerostar.oracle.texts import avg, cnt_if, div, money, pct, rnd, total
from aerostar.plans import analytics as A
from aerostar.plans import dashboard as V
from aerostar.plans import marts as M
from aerostar.sources.star import derive_star
from tools.compare import compare, duck

from conftest import SMALL

#: Fleet groups: aircraft in service by manufacturer, model and age.
FLEET = "craft AS (SELECT * FROM DimAircraft WHERE IsCurrent)"
DAYS = "day AS (SELECT * FROM DimDate WHERE Year >= 2023)"

SQL = {}


def text(name: str, body: str, *ctes: str) -> None:
    SQL[name] = with_prelude(body, ",\n".join(ctes))


text("maintenance_reliability", f"""
SELECT Age, Model, Manufacturer, {total("events")} AS MaintenanceEvents, {money("cost")} AS TotalMaintenanceCost,
       {div("SUM(cost)", "SUM(cost_n)")} AS AvgCostPerEvent, {money("hours")} AS TotalDowntimeHours,
       {total("hit")} AS TotalFlightsAffected, {div("SUM(cost)", "SUM(flights)")} AS CostPerFlightHour
FROM craft JOIN shop USING (AircraftKey) LEFT JOIN flown USING (AircraftKey)
GROUP BY ALL
""", FLEET, """shop AS (
  SELECT AircraftKey, COUNT(DISTINCT MaintenanceKey) AS events, SUM(TotalCost) AS cost,
         COUNT(TotalCost) AS cost_n, SUM(DowntimeHours) AS hours, SUM(FlightsAffected) AS hit
  FROM FactMaintenance GROUP BY AircraftKey)""",
     "flown AS (SELECT AircraftKey, COUNT(DISTINCT FlightFactKey) AS flights FROM FactFlight GROUP BY AircraftKey)")

text("aircraft_utilization_mart", f"""
SELECT AircraftKey, TailNumber, Model, Manufacturer, Age, COALESCE(events, 0) AS MaintenanceEvents,
       CAST(cost AS DOUBLE) AS MaintenanceCosts, CAST(hours AS DOUBLE) AS TotalDowntime,
       COALESCE(flights, 0) AS TotalFlights, COALESCE(days, 0) AS DaysOperated,
       {div("minutes", "60")} AS TotalFlightHours, load AS AvgLoadFactor, CAST(earned AS DOUBLE) AS TotalRevenue
FROM craft LEFT JOIN flown USING (AircraftKey) LEFT JOIN shop USING (AircraftKey)
""", FLEET, f"""flown AS (
  SELECT AircraftKey, COUNT(*) AS flights, COUNT(DISTINCT DateKey) AS days, SUM(AirTimeMin) AS minutes,
         {avg("LoadFactor")} AS load, SUM(Revenue) AS earned
  FROM FactFlight GROUP BY AircraftKey)""", """shop AS (
  SELECT AircraftKey, COUNT(MaintenanceKey) AS events, SUM(TotalCost) AS cost, SUM(DowntimeHours) AS hours
  FROM FactMaintenance GROUP BY AircraftKey)""")

# Both sides in one list; a month without rows keeps its line.
text("monthly_revenue", f"""
SELECT Year, Month, MonthName, COUNT(DISTINCT flight) AS TotalFlights, {money("seats")} AS FlightRevenue,
       {money("hold")} AS CargoRevenue, CAST(COALESCE(SUM(seats), 0) + COALESCE(SUM(hold), 0) AS DOUBLE) AS TotalRevenue
FROM day LEFT JOIN income USING (DateKey)
GROUP BY ALL
""", DAYS, """income AS (
  SELECT DateKey, FlightFactKey AS flight, Revenue AS seats, NULL AS hold FROM FactFlight
  UNION ALL SELECT DateKey, NULL, NULL, Revenue FROM FactCargo)""")

text("cost_breakdown", """
SELECT Year, Quarter, CAST(SUM(amount) FILTER (WHERE kind = 'fuel') AS DOUBLE) AS FuelCost,
       CAST(SUM(amount) FILTER (WHERE kind = 'crew') AS DOUBLE) AS CrewCost,
       CAST(SUM(amount) FILTER (WHERE kind = 'fees') AS DOUBLE) AS AirportFees,
       CAST(SUM(amount) FILTER (WHERE kind = 'repair') AS DOUBLE) AS MaintenanceCost,
       CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS TotalCost
FROM day LEFT JOIN item USING (DateKey)
GROUP BY ALL
""", DAYS, """item AS (
  SELECT DateKey, 'fuel' AS kind, FuelCost AS amount FROM FactFlight
  UNION ALL SELECT DateKey, 'crew', CrewCost FROM FactFlight
  UNION ALL SELECT DateKey, 'fees', AirportFees FROM FactFlight
  UNION ALL SELECT DateKey, 'repair', TotalCost FROM FactMaintenance)""")

text("executive_kpis", f"""
SELECT 'Last 30 Days' AS Period, bookings AS TotalBookings, customers AS ActiveCustomers,
       COUNT(DISTINCT FlightFactKey) AS TotalFlights,
       {pct(cnt_if("ArrivalDelayMin <= 15"), "COUNT(*)")} AS OnTimePerformance,
       {rnd("SUM(Revenue) * 100", "SUM(CAST(SeatsAvailable AS BIGINT) * DistanceMiles) * 100", 4)} AS RASM,
       {rnd("SUM(LoadFactor) * 100", "COUNT(LoadFactor) * 100", 2)} AS AvgLoadFactor, {money("Revenue")} AS TotalRevenue
FROM recent, sold
GROUP BY bookings, customers
""", "recent AS (SELECT * FROM FactFlight WHERE DateKey IN (SELECT DateKey FROM DimDate WHERE Date >= DATE '2024-12-01'))",
     """sold AS (
  SELECT COUNT(DISTINCT BookingKey) AS bookings, COUNT(DISTINCT CustomerKey) AS customers
  FROM FactBooking WHERE FlightKey IN (SELECT FlightKey FROM recent))""")

text("loyalty_performance", f"""
SELECT LoyaltyTier, {rnd("COALESCE(SUM(n), 0)", "COUNT(*)", 2)} AS BookingsPerCustomer,
       {div("SUM(amount)", "SUM(amount_n)")} AS AvgBookingValue, {money("amount")} AS Revenue,
       CAST(COALESCE(SUM(n), 0) AS BIGINT) AS Bookings, COUNT(*) AS Customers
FROM DimCustomer LEFT JOIN buyer USING (CustomerKey)
WHERE IsCurrent GROUP BY LoyaltyTier
""", """buyer AS (
  SELECT CustomerKey, COUNT(BookingKey) AS n, SUM(TotalAmount) AS amount, COUNT(TotalAmount) AS amount_n
  FROM FactBooking WHERE DateKey >= 20240101 GROUP BY CustomerKey)""")

# A customer returns in a quarter when an earlier one holds the first booking.
text("customer_retention", f"""
SELECT Year, Quarter, COUNT(*) AS ActiveCustomers, {cnt_if("back")} AS ReturningCustomers,
       {pct(cnt_if("back"), "COUNT(*)")} AS RetentionRate
FROM (SELECT DISTINCT CustomerKey, Year, Quarter,
             first_key < Year * 10000 + (Quarter * 3 - 2) * 100 + 1 AS back
      FROM (SELECT *, MIN(DateKey) OVER (PARTITION BY CustomerKey) AS first_key FROM FactBooking) JOIN day USING (DateKey))
GROUP BY ALL
""", DAYS)

text("monthly_flight_summary", f"""
SELECT CarrierName, Year, Month, MonthName, {pct("SUM(punctual)", "SUM(n)")} AS OTP, {total("punctual")} AS OnTimeFlights,
       {total("cancelled")} AS Cancellations, {total("n")} AS TotalFlights, {total("filled")} AS TotalPassengers,
       {total("offered")} AS TotalSeats, {rnd("SUM(load) * 100", "SUM(load_n) * 100", 2)} AS AvgLoadFactor,
       {money("spent")} AS TotalCosts, {money("earned")} AS TotalRevenue
FROM cell JOIN DimCarrier USING (CarrierKey)
GROUP BY ALL
""", f"""cell AS (
  SELECT CarrierKey, Year, Month, MonthName, COUNT(*) AS n, {cnt_if("ArrivalDelayMin <= 15")} AS punctual,
         {cnt_if("CancellationFlag")} AS cancelled, SUM(SeatsFilled) AS filled, SUM(SeatsAvailable) AS offered,
         SUM(LoadFactor) AS load, COUNT(LoadFactor) AS load_n, SUM(Revenue) AS earned,
         SUM(COALESCE(FuelCost, 0) + COALESCE(CrewCost, 0) + COALESCE(AirportFees, 0)) AS spent
  FROM FactFlight JOIN DimDate USING (DateKey) GROUP BY CarrierKey, Year, Month, MonthName)""")

JOBS = {
    "maintenance_reliability": A.maintenance_reliability,
    "aircraft_utilization_mart": M.aircraft_utilization_mart,
    "monthly_revenue": V.monthly_revenue,
    "cost_breakdown": V.cost_breakdown,
    "executive_kpis": V.executive_kpis,
    "loyalty_performance": V.loyalty_performance,
    "customer_retention": V.customer_retention,
    "monthly_flight_summary": M.monthly_flight_summary,
}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(JOBS))
def test_corrected_mode_matches_sql(spark, con, name):
    wh = derive_star(spark, SMALL)
    ok, msg = compare(JOBS[name](wh, mode="corrected"), con, SQL[name])
    assert ok, msg
