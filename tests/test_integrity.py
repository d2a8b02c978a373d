"""Foreign keys: every orphan counted, rows rejected one by one with their reasons, clean rows kept."""
from pyspark.sql import functions as F

from aerostar.operators import integrity as I


def test_there_are_21_keys_and_several_have_orphans(wh):
    rows = {r.CheckName: r for r in I.dq_foreign_keys(wh).collect()}
    assert len(rows) == 21 == len(I.ALL_KEYS)
    assert sum(r.Failures > 0 for r in rows.values()) >= 4
    assert all(r.Passed == (r.Failures == 0) for r in rows.values())


def _star(spark, wh):
    cargo = spark.createDataFrame(
        [(1, 0, 20240101, 0, 1), (1, 0, 20240101, 0, 77), (2, None, 20240101, 88, 77), (3, 5, 19000101, 0, 1), (4, 5, None, 0, 1)],
        "CargoKey long, FlightKey long, DateKey int, DepartureAirportKey int, ArrivalAirportKey int")
    flights = spark.createDataFrame([(5, 1, 2, 3)], "FlightKey long, CarrierKey int, DepartureAirportKey int, ArrivalAirportKey int")
    empty = {t: getattr(wh, t).limit(0) for t in ("fact_flight", "fact_booking", "fact_maintenance")}
    return wh.with_tables(fact_cargo=cargo, flight=flights, **empty)


def test_rows_are_rejected_by_row_also_where_keys_repeat(spark, wh, scratch):
    star = _star(spark, wh)
    got = sorted((r.RowKey, r.MissingKeys) for r in I.quarantined(star).collect())
    assert got == [(1, "FlightKey"), (1, "FlightKey,ArrivalAirportKey"), (2, "DepartureAirportKey,ArrivalAirportKey"), (3, "DateKey")]
    counts = {r.CheckName: r.Failures for r in I.dq_foreign_keys(star).collect() if r.Failures}
    assert counts == {"FactCargo.FlightKey": 2, "FactCargo.ArrivalAirportKey": 2, "FactCargo.DepartureAirportKey": 1,
                      "FactCargo.DateKey": 1}
    clean = I.load_checked(star, scratch)
    assert [r.CargoKey for r in clean.fact_cargo.collect()] == [4]
    assert clean.fact_cargo.columns == star.fact_cargo.columns
    kept = spark.read.parquet(f"{scratch}/fact_cargo").filter("Rejected = 1")
    assert kept.count() == 4 and kept.filter(F.size("MissingKeys") == 2).count() == 2
    assert clean.fact_booking.count() == 0


def test_each_table_is_scanned_once_for_its_report(wh):
    plan = I._values(wh, "fact_flight")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
