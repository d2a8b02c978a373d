"""Property test: the fan-out rewrites equal the literal many-to-many joins
on random facts (NULL measures, keys without partners, hot keys)."""
import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostar.plans import dashboard as V
from aerostar.plans import marts as M

money = st.one_of(st.none(), st.integers(0, 5000).map(lambda c: Decimal(c) / 100))
days = st.sampled_from([20240105, 20240210, 20240301, 20240720])
flight = st.tuples(st.integers(0, 4), days, st.one_of(st.none(), st.integers(30, 300)),
                   money, money, money, money,
                   st.one_of(st.none(), st.integers(6000, 9999).map(lambda c: Decimal(c) / 100)))
maint = st.tuples(st.integers(0, 5), days, money, money)


def _facts(spark, wh, flights, maints):
    ff_rows = []
    for i, (ac, dk, air, rev, fuel, crew, fees, lf) in enumerate(flights):
        ff_rows.append((i, 1, dk, ac, 1, 2, 1, None, 0, 0, air, 200, 150, lf, rev, fuel, crew,
                        fees, False, False, False, 500))
    m_rows = [(100 + i, ac, dk, 1, dt.date(dk // 10000, dk // 100 % 100, dk % 100), cost, down, 1)
              for i, (ac, dk, cost, down) in enumerate(maints)]
    ff = spark.createDataFrame(ff_rows, wh.fact_flight.drop("ActualDepartureTime", "ActualArrivalTime").schema)
    fm = spark.createDataFrame(m_rows, wh.fact_maintenance.schema)
    return wh.with_tables(fact_flight=ff, fact_maintenance=fm)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(flights=st.lists(flight, min_size=0, max_size=25), maints=st.lists(maint, max_size=12))
def test_fanout_rewrites_equal_literal_joins(spark, wh, flights, maints):
    w = _facts(spark, wh, flights, maints)
    # Aircraft LEFT JOIN flights LEFT JOIN maintenance, literally.
    ac = w.aircraft.filter("IsCurrent").alias("ac")
    ex = (ac.join(w.fact_flight.alias("ff"), F.col("ac.AircraftKey") == F.col("ff.AircraftKey"), "left")
          .join(w.fact_maintenance.alias("fm"), F.col("ac.AircraftKey") == F.col("fm.AircraftKey"), "left"))
    expect = ex.groupBy("ac.AircraftKey", "ac.TailNumber", "ac.Manufacturer", "ac.Model", "ac.Age").agg(
        F.countDistinct("ff.DateKey"), F.count(F.lit(1)),
        F.sum("ff.AirTimeMin").cast("double") / 60.0,
        F.try_divide(F.sum("ff.LoadFactor").cast("double"), F.count("ff.LoadFactor").cast("double")),
        F.sum("ff.Revenue").cast("double"), F.count("fm.MaintenanceKey"),
        F.sum("fm.TotalCost").cast("double"), F.sum("fm.DowntimeHours").cast("double"))
    assert _rows(M.aircraft_utilization_mart(w)) == _rows(expect)
    # Calendar LEFT JOIN flights LEFT JOIN maintenance on the date, literally.
    d = w.date.filter("Year >= 2023").alias("d")
    ex = (d.join(w.fact_flight.alias("ff"), F.col("d.DateKey") == F.col("ff.DateKey"), "left")
          .join(w.fact_maintenance.alias("fm"), F.col("d.DateKey") == F.col("fm.DateKey"), "left"))
    costs = F.col("ff.FuelCost") + F.col("ff.CrewCost") + F.col("ff.AirportFees")
    expect = ex.groupBy("d.Year", "d.Quarter").agg(
        F.sum("ff.FuelCost").cast("double"), F.sum("ff.CrewCost").cast("double"),
        F.sum("ff.AirportFees").cast("double"), F.sum("fm.TotalCost").cast("double"),
        (F.sum(costs) + F.sum("fm.TotalCost")).cast("double"))
    assert _rows(V.cost_breakdown(w)) == _rows(expect)
