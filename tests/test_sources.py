import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from aerostar.operators.audit import audited_load, audited_upsert
from aerostar.operators.etl import aggregate_children, derive_delays, weather_match
from aerostar.plans.marts import current_mart, mart_versions, refresh_marts
from aerostar.sources.extract import read_schedule, schedule_to_dim_flight

CSV = """FlightNumber,CarrierCode,DepartureAirport,ArrivalAirport,ScheduledDeparture,ScheduledArrival,DistanceMiles
XA10,C0,A01,A02,08:00:00,10:30:00,500
XA11,C1,A02,A01,22:00:00,01:15:00,500
XA12,ZZ,A03,A99,06:00:00,07:00:00,200
"""


def test_schedule_csv(spark, wh, scratch):
    path = os.path.join(scratch, "schedule.csv")
    with open(path, "w") as fh:
        fh.write(CSV)
    sched = read_schedule(spark, path)
    rows = {r.FlightNumber: r for r in sched.collect()}
    assert rows["XA11"].ScheduledDurationMin == 195          # overnight
    dims = {r.FlightNumber: r for r in schedule_to_dim_flight(sched, wh.airport, wh.carrier).collect()}
    assert [dims[k].FlightKey for k in ("XA10", "XA11", "XA12")] == [1, 2, 3]
    assert dims["XA10"].DepartureAirportKey == 1 and dims["XA12"].ArrivalAirportKey is None
    assert dims["XA12"].CarrierKey is None


def test_refresh_marts_writes_versions(spark, wh, scratch):
    paths = refresh_marts(wh, scratch, "20241231")
    assert set(paths) == {"mv_monthly_flight_summary", "mv_route_performance", "mv_customer_ltv",
                          "mv_aircraft_utilization", "mv_daily_operations"}
    assert spark.read.parquet(paths["mv_monthly_flight_summary"]).count() > 0
    assert mart_versions(spark, scratch) == [1]


def test_a_reader_keeps_its_version_through_refreshes_of_the_same_label(spark, wh, scratch):
    first = refresh_marts(wh, scratch, "20241231")
    held = current_mart(spark, scratch, "mv_customer_ltv", mart_versions(spark, scratch)[-1])
    before = sorted(map(tuple, held.select("CustomerID", "TotalBookings").collect())) if "CustomerID" in held.columns else held.count()
    fewer = wh.with_tables(customer=wh.customer.filter("CustomerKey % 2 = 0"))
    second = refresh_marts(fewer, scratch, "20241231")
    assert not set(first.values()) & set(second.values()) and mart_versions(spark, scratch) == [1, 2]
    after = sorted(map(tuple, held.select("CustomerID", "TotalBookings").collect())) if "CustomerID" in held.columns else held.count()
    assert after == before
    latest = current_mart(spark, scratch, "mv_customer_ltv")
    assert latest.count() < held.count() == current_mart(spark, scratch, "mv_customer_ltv", 1).count()


def test_a_refresh_that_fails_publishes_nothing(spark, wh, scratch):
    refresh_marts(wh, scratch, "a")
    bad = wh.with_tables(fact_flight=wh.fact_flight.withColumn(
        "Revenue", F.raise_error(F.lit("lost")).cast("decimal(12,2)")))
    with pytest.raises(Exception, match="lost"):
        refresh_marts(bad, scratch, "b")
    assert mart_versions(spark, scratch) == [1]
    assert current_mart(spark, scratch, "mv_monthly_flight_summary").count() > 0
    with pytest.raises(ValueError):
        current_mart(spark, scratch, "mv_customer_ltv", 9)


def test_an_audited_upsert_tells_inserts_updates_and_rejects(spark, scratch):
    kind = "k long, day int, a int, u int, seq int"
    valid = spark.createDataFrame([(1, 20240105, 1, 10, 1), (1, 20240107, 1, 11, 2), (2, 20240106, 2, 20, 1), (2, 20240101, 3, 21, 2)], kind)
    bad = spark.createDataFrame([(9, 20240109, 0, 0, 1, "why")], kind + ", RejectReason string")
    known = spark.createDataFrame([(1,), (1,), (7,)], "k long")
    dq = spark.createDataFrame([("c", 0)], "CheckName string, Failures int")
    args = (known, valid, bad, f"{scratch}/load", f"{scratch}/logs", "k", ["u"], ["k", "day", "a", "u"], "seq", "day")
    out = audited_upsert(spark, "j", *args, dq=dq)
    assert [out[c] for c in ("rows_processed", "rows_inserted", "rows_updated", "rows_rejected")] == [5, 1, 3, 1]
    assert (out["watermark_key"], out["watermark_id"], out["status"]) == (20240109, 9, "success")
    load = {(r.k, r.LoadAction): (r.a, r.u) for r in spark.read.parquet(f"{scratch}/load").collect()}
    assert load == {(1, "update"): (1, 11), (2, "insert"): (2, 21), (9, "reject"): (0, 0)}
    assert [r.RejectReason for r in spark.read.parquet(f"{scratch}/logs/etl_error_log").collect()] == ["why"]
    assert spark.read.parquet(f"{scratch}/logs/data_quality_log").count() == 1
    with pytest.raises(RuntimeError):  # the folder is taken: nothing is loaded, the entry says so
        audited_upsert(spark, "j", *args)
    assert sorted(r.status for r in spark.read.parquet(f"{scratch}/logs/etl_audit_log").collect()) == ["failed", "success"]


def test_audit_log(spark, scratch):
    valid = spark.range(5)
    rejected = spark.range(2).withColumn("RejectReason", F.lit("x"))
    out = audited_load(spark, "flights", valid, rejected, f"{scratch}/out", f"{scratch}/logs")
    assert (out["rows_written"], out["rows_rejected"], out["status"]) == (5, 2, "success")
    assert spark.read.parquet(f"{scratch}/logs/etl_audit_log").count() == 1


def test_derive_delays_and_children(spark):
    src = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8, 0), dt.datetime(2024, 1, 1, 8, 20),
                                  dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 9, 50))],
                                "scheduled_departure timestamp, actual_departure timestamp, "
                                "scheduled_arrival timestamp, actual_arrival timestamp")
    r = derive_delays(src).first()
    assert (r.DepartureDelayMin, r.ArrivalDelayMin) == (20, -10)
    parent = spark.createDataFrame([(1,), (2,)], "b int")
    kids = spark.createDataFrame([(1, 5), (1, 7)], "b int, pts int")
    got = {x.b: x.pts for x in aggregate_children(parent, kids, "b", {"pts": F.sum("pts")}).collect()}
    assert got == {1: 12, 2: None}


def test_weather_match(spark, wh):
    flights = spark.createDataFrame([(1, "A01", dt.datetime(2024, 1, 1, 8, 40))],
                                    "id int, departure_airport string, departure_time timestamp")
    obs = spark.createDataFrame([
        ("A01", dt.datetime(2024, 1, 1, 8, 5), "Weather 3", "Severe"),
        ("A01", dt.datetime(2024, 1, 1, 8, 50), "Weather 2", "Moderate"),
        ("A01", dt.datetime(2024, 1, 1, 9, 5), "Weather 1", "None"),
    ], "airport_code string, timestamp timestamp, condition string, severity string")
    out = weather_match(flights, obs, wh.weather,
                        {"None": "Low", "Moderate": "Medium", "Severe": "High"}).first()
    assert out.WeatherKey == 2


def test_cli_list_and_run(spark, scratch, capsys):
    from aerostar.cli import main
    assert main(["list"]) == 0
    listed = capsys.readouterr().out.split()
    assert "otp_by_route" in listed and "flight_upsert" in listed
    from conftest import SMALL
    assert main(["run", "kpi_overview", "--sf-dir", SMALL, "--out", f"{scratch}/kpi"]) == 0
    assert spark.read.parquet(f"{scratch}/kpi").count() == 1



def test_cli_run_all_subset(spark, scratch):
    from aerostar.cli import main
    from conftest import SMALL
    assert main(["run-all", "--sf-dir", SMALL, "--out", f"{scratch}/reports",
                 "--jobs", "daily_otp,delay_causes"]) == 0
    assert spark.read.parquet(f"{scratch}/reports/delay_causes").count() == 2
    assert main(["run-all", "--sf-dir", SMALL, "--out", f"{scratch}/r2", "--jobs", "nope"]) == 2
