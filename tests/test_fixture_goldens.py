"""The derived star reproduces the profile published in FIXTURES.md §3 (sf0.01)."""
from decimal import Decimal

from pyspark.sql import functions as F

from aerostar.sources.star import derive_star


def test_fixture_profile_sf001(spark):
    wh = derive_star(spark, "/root/testdata/sf0.01")
    ff = wh.fact_flight
    assert ff.count() == 60000
    assert ff.filter(F.col("DateKey").between(20240101, 20241231)).count() == 8619
    assert ff.filter("CancellationFlag").count() == 2930
    assert ff.filter("ArrivalDelayMin <= 15").count() == 14678
    assert ff.join(wh.flight, "FlightKey", "left_anti").count() == 646
    assert ff.filter("DateKey > 20241231").count() == 15995
    current = wh.customer.filter("IsCurrent")
    assert current.join(wh.fact_booking, "CustomerKey", "left_anti").count() == 30
    assert (wh.fact_cargo.count(), wh.fact_cargo.filter("WeightKg = 0").count()) == (20046, 384)
    assert wh.aircraft.join(wh.fact_maintenance, "AircraftKey", "left_anti").count() == 90
    lo, hi = ff.agg(F.min("LoadFactor"), F.max("LoadFactor")).first()
    assert (lo, hi) == (Decimal("66.67"), Decimal("101.96"))
    assert (wh.fact_booking.count(), wh.fact_maintenance.count(), wh.flight.count()) == (15000, 2014, 2000)
    bad = ("LoadFactor > 100", "DepartureDelayMin > 1440", "ArrivalDelayMin < -60", "Revenue < 0", "ActualArrivalTime <= ActualDepartureTime")
    assert [ff.filter(rule).count() for rule in bad] == [53, 65, 53, 65, 123]
