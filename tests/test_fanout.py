"""The fan-out rewrites give the numbers of the literal many-to-many joins."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from aerostar.plans import dashboard as V
from aerostar.plans import marts as M
from aerostar.plans import analytics as A


def _star(spark, wh):
    """Tiny facts with NULL measures, keys without partners, and fan-out."""
    ff = spark.createDataFrame([
        (1, 1, 20240105, 1, 1, 2, 1, None, 5, 10, 60, 200, 150, Decimal("75.00"), Decimal("100.00"),
         Decimal("1.00"), Decimal("2.00"), Decimal("3.00"), False, False, False, 500),
        (2, 1, 20240105, 1, 1, 2, 1, None, 5, 20, 60, 200, 150, None, Decimal("50.00"),
         Decimal("1.00"), None, Decimal("3.00"), False, False, False, 500),
        (3, 2, 20240210, 2, 1, 2, 1, None, 5, 30, 90, 100, 50, Decimal("50.00"), None,
         Decimal("1.00"), Decimal("2.00"), Decimal("3.00"), True, False, False, 300),
    ], wh.fact_flight.drop("ActualDepartureTime", "ActualArrivalTime").schema)
    fm = spark.createDataFrame([
        (10, 1, 20240105, 1, dt.date(2024, 1, 5), Decimal("7.00"), Decimal("1.00"), 2),
        (11, 1, 20240301, 1, dt.date(2024, 3, 1), None, Decimal("2.00"), 1),
        (12, 3, 20240105, 1, dt.date(2024, 1, 5), Decimal("5.00"), None, 0),
    ], wh.fact_maintenance.schema)
    ac = spark.createDataFrame([
        (1, "N1", "T", "Boeing", "M1", 150, 2020, 4, "Owned", dt.date(2020, 1, 1), None, True),
        (2, "N2", "T", "Boeing", "M1", 150, 2020, 4, "Owned", dt.date(2020, 1, 1), None, True),
        (3, "N3", "T", "Airbus", "M2", 150, 2020, 9, "Owned", dt.date(2020, 1, 1), None, True),
        (4, "N4", "T", "Airbus", "M2", 150, 2020, 9, "Owned", dt.date(2020, 1, 1), None, True),
    ], wh.aircraft.schema)
    fc = spark.createDataFrame([
        (100, 1, 20240105, 1, 2, Decimal("10.00"), Decimal("4.00"), True),
        (101, 1, 20240105, 1, 2, Decimal("0.00"), None, True),
    ], wh.fact_cargo.schema)
    return wh.with_tables(fact_flight=ff, fact_maintenance=fm, aircraft=ac, fact_cargo=fc)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_aircraft_mart_matches_exploded_join(spark, wh):
    w = _star(spark, wh)
    ac = w.aircraft.filter("IsCurrent").alias("ac")
    ex = (ac.join(w.fact_flight.alias("ff"), F.col("ac.AircraftKey") == F.col("ff.AircraftKey"), "left")
          .join(w.fact_maintenance.alias("fm"), F.col("ac.AircraftKey") == F.col("fm.AircraftKey"), "left"))
    keys = ["ac.AircraftKey", "ac.TailNumber", "ac.Manufacturer", "ac.Model", "ac.Age"]
    expect = ex.groupBy(*keys).agg(
        F.countDistinct("ff.DateKey"), F.count(F.lit(1)),
        F.sum("ff.AirTimeMin").cast("double") / 60.0,
        F.try_divide(F.sum("ff.LoadFactor").cast("double"), F.count("ff.LoadFactor").cast("double")),
        F.sum("ff.Revenue").cast("double"), F.count("fm.MaintenanceKey"),
        F.sum("fm.TotalCost").cast("double"), F.sum("fm.DowntimeHours").cast("double"))
    assert _rows(M.aircraft_utilization_mart(w)) == _rows(expect)


def test_maintenance_reliability_matches_exploded_join(spark, wh):
    w = _star(spark, wh)
    ac = w.aircraft.filter("IsCurrent").alias("ac")
    ex = (ac.join(w.fact_maintenance.alias("fm"), F.col("ac.AircraftKey") == F.col("fm.AircraftKey"))
          .join(w.fact_flight.alias("ff"), F.col("ac.AircraftKey") == F.col("ff.AircraftKey"), "left"))
    expect = ex.groupBy("ac.Manufacturer", "ac.Model", "ac.Age").agg(
        F.countDistinct("fm.MaintenanceKey"), F.sum("fm.TotalCost").cast("double"),
        F.try_divide(F.sum("fm.TotalCost").cast("double"), F.count("fm.TotalCost").cast("double")),
        F.sum("fm.DowntimeHours").cast("double"), F.sum("fm.FlightsAffected").cast("long"),
        F.try_divide(F.sum("fm.TotalCost").cast("double"),
                     F.countDistinct("ff.FlightFactKey").cast("double")))
    assert _rows(A.maintenance_reliability(w)) == _rows(expect)


def test_cost_breakdown_and_monthly_revenue_keep_nulls(spark, wh):
    w = _star(spark, wh)
    q1 = {(r.Year, r.Quarter): r for r in V.cost_breakdown(w).collect()}[(2024, 1)]
    # Jan 5: 2 flights x 2 maintenance rows; Feb 10: 1 flight; Mar 1: 1 maintenance.
    assert q1.FuelCost == (1 + 1) * 2 + 1
    assert q1.CrewCost == 2 * 2 + 2            # NULL crew cost skipped by SUM
    assert q1.MaintenanceCost == (7 + 5) * 2   # Mar 1 TotalCost is NULL
    assert q1.TotalCost == (6 * 2 + 6) + 24    # flight 2's NULL crew drops its row cost
    jan = {(r.Year, r.Month): r for r in V.monthly_revenue(w).collect()}[(2024, 1)]
    assert jan.FlightRevenue == 150 * 2 and jan.CargoRevenue == 4 * 2 and jan.TotalFlights == 2
    mar = {(r.Year, r.Month): r for r in V.monthly_revenue(w).collect()}[(2024, 3)]
    assert mar.FlightRevenue is None and mar.TotalRevenue is None and mar.TotalFlights == 0


def test_delay_causes_has_two_rows_on_empty_input(spark, wh):
    w = wh.with_tables(fact_flight=wh.fact_flight.limit(0))
    rows = {r.DelayType: r for r in V.delay_causes(w).collect()}
    assert set(rows) == {"Weather", "Mechanical"}
    assert rows["Weather"].FlightCount == 0 and rows["Weather"].AvgDelayMin is None


def test_corrected_modes_count_each_fact_once(spark, wh):
    w = _star(spark, wh)
    mart = {r.AircraftKey: r for r in M.aircraft_utilization_mart(w, mode="corrected").collect()}
    assert (mart[1].TotalFlights, mart[1].MaintenanceEvents) == (2, 2)
    assert mart[1].TotalRevenue == 150 and mart[1].MaintenanceCosts == 7
    assert (mart[4].TotalFlights, mart[4].MaintenanceEvents) == (0, 0)
    rel = {r.Manufacturer: r for r in A.maintenance_reliability(w, mode="corrected").collect()}
    assert rel["Boeing"].TotalMaintenanceCost == 7 and rel["Airbus"].TotalMaintenanceCost == 5
    q1 = {(r.Year, r.Quarter): r for r in V.cost_breakdown(w, mode="corrected").collect()}[(2024, 1)]
    assert (q1.FuelCost, q1.MaintenanceCost) == (3, 12)
    assert q1.TotalCost == (6 + 4 + 6) + 12        # NULL crew cost counted as 0
    mar = {(r.Year, r.Month): r for r in V.monthly_revenue(w, mode="corrected").collect()}[(2024, 3)]
    assert mar.TotalRevenue == 0
    import pytest
    with pytest.raises(ValueError):
        V.cost_breakdown(w, mode="other")


def test_corrected_customer_views(spark, wh):
    ref = {r.LoyaltyTier: r for r in V.loyalty_performance(wh).collect()}
    cor = {r.LoyaltyTier: r for r in V.loyalty_performance(wh, mode="corrected").collect()}
    for tier, r in cor.items():
        assert r.Customers >= (ref[tier].Customers if tier in ref else 0)
        if tier in ref:
            assert r.Bookings == ref[tier].Bookings
    ref = {(r.Year, r.Quarter): r for r in V.customer_retention(wh).collect()}
    cor = {(r.Year, r.Quarter): r for r in V.customer_retention(wh, mode="corrected").collect()}
    assert set(ref) == set(cor)
    for k, r in cor.items():
        assert r.ActiveCustomers == ref[k].ActiveCustomers
        if k[0] == 2023:
            assert r.ReturningCustomers <= ref[k].ReturningCustomers
        else:
            assert r.ReturningCustomers >= ref[k].ReturningCustomers
    k_ref = V.executive_kpis(wh).first()
    k_cor = V.executive_kpis(wh, mode="corrected").first()
    assert k_ref.TotalFlights == k_cor.TotalFlights


def test_unique_key_counts_equal_distinct_counts(spark, wh):
    # The derived facts have unique keys (P15 finds no duplicates), so the
    # count-based variants must reproduce the exact distinct counts.
    from aerostar.operators.quality import dq_duplicates
    for fact, key in ((wh.fact_flight, "FlightFactKey"), (wh.fact_booking, "BookingKey"),
                      (wh.fact_maintenance, "MaintenanceKey")):
        assert dq_duplicates(fact, key).count() == 0
    for fn in (A.fare_class_yield, A.maintenance_reliability, V.monthly_revenue, V.executive_kpis):
        assert _rows(fn(wh, unique_keys=True)) == _rows(fn(wh)), fn.__name__
