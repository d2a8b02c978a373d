"""What is grouped and joined by the flight key is dealt by it once, as narrow lines."""
import datetime as dt
import re

import pytest

from aerostar.plans import etl_jobs

LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
DAY = dt.datetime(1995, 3, 4)


def line(order, number, quantity, day=DAY):
    return (order, 7, 3, number, float(quantity), 100.0, 0.01, 0.0, "N", "O", day)


@pytest.fixture()
def lines(spark, scratch):
    # A key that comes once, one that comes twice and one that no stored fact has (every 50th order).
    rows = [line(1, 1, 10), line(2, 1, 20), line(2, 1, 25), line(50, 1, 30), line(50, 1, 35)]
    spark.createDataFrame(rows, LINES).write.parquet(f"{scratch}/lineitem.parquet")
    for name in ("nation", "region", "customer", "supplier", "part", "orders", "events"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(5).write.parquet(f"{scratch}/{name}.parquet")
    return scratch


def exchanges(df) -> list[str]:
    """The partitionings of the plan's shuffles, before adaptive execution."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*), \d+\), \w+", plan)


def test_the_upsert_moves_no_record_by_its_key_again(spark, lines):
    df = etl_jobs.flight_upsert(spark, lines)
    assert exchanges(df) and not [x for x in exchanges(df) if x.startswith("FlightFactKey")]
    got = sorted((r.FlightFactKey, r.SeatsFilled) for r in df.collect())
    moved = 1 << 40  # the second line of a key is a fact of its own
    # Known keys take the last record's seats, the new key too; stored facts without a record keep theirs.
    assert got == sorted([(9, 147), (17, 132), (17 + moved, 132), (401, 127), (401 + moved, 122), (-401, 122)])


def test_the_audited_load_deals_the_batch_by_its_key_once(spark, lines, monkeypatch):
    from aerostar.operators import audit
    plans, classify = [], audit.classified

    def seen(*args):
        plans.append(classify(*args))
        return plans[-1]

    monkeypatch.setattr(audit, "classified", seen)
    got = etl_jobs.etl_audit(spark, lines).first()
    assert exchanges(plans[0]) and not [x for x in exchanges(plans[0]) if x.startswith(("FlightFactKey", "_known"))]
    assert (got.rows_processed, got.rows_inserted, got.rows_updated, got.rows_rejected) == (5, 1, 4, 0)


def test_the_marts_read_a_flight_base_that_is_computed_once(spark, lines, monkeypatch):
    from aerostar.plans import marts
    stars, refresh = [], marts.refresh_marts

    def seen(wh, *args):
        stars.append(wh)
        return refresh(wh, *args)

    monkeypatch.setattr(marts, "refresh_marts", seen)
    assert {r.Mart: r.Rows for r in etl_jobs.mart_rows(spark, lines).collect()}["mv_monthly_flight_summary"] == 1
    assert len(stars) == 2 and etl_jobs.mart_refresh(spark, lines).count() == 1
    for wh in stars:
        assert "Window" not in wh.fact_flight._jdf.queryExecution().executedPlan().toString()


def test_the_stream_deals_each_arrival_by_its_key_once(spark, lines, monkeypatch):
    from aerostar.streaming import months
    seen, upsert = [], months.upsert_months

    def note(table, batch, *args):
        seen.append(exchanges(batch.groupBy("FlightFactKey").count()))
        return upsert(table, batch, *args)

    monkeypatch.setattr(months, "upsert_months", note)
    got = sorted((r.FlightFactKey, r.SeatsFilled) for r in etl_jobs.flight_upsert_stream(spark, lines).collect())
    assert len(seen) == 2 and all(seen) and not [x for xs in seen for x in xs if x.startswith("FlightFactKey")]
    assert got == sorted((r.FlightFactKey, r.SeatsFilled) for r in etl_jobs.flight_upsert(spark, lines).collect())


def test_aircraft_days_are_dealt_and_grouped_once(spark, lines):
    import decimal

    from aerostar.plans import dashboard
    from aerostar.sources.star import derive_star
    flights = spark.createDataFrame(
        [(1, 20200101, 60, decimal.Decimal("50.00")), (1, 20200101, 30, None), (2, 20200101, None, decimal.Decimal("80.00")),
         (2, 20200102, 30, decimal.Decimal("20.00")), (3, None, 15, decimal.Decimal("10.00")), (None, 20200101, 5, None),
         (4, 20200103, 5, None)],
        "AircraftKey long, DateKey int, AirTimeMin int, LoadFactor decimal(5,2)")
    # Keys 1 and 2 are one tail number; key 3 comes twice; key 4 isn't current.
    aircraft = spark.createDataFrame(
        [(1, "N1", "M", True), (2, "N1", "M", True), (3, None, "M", True), (3, None, "M", True), (4, "N4", "M", False)],
        "AircraftKey long, TailNumber string, Model string, IsCurrent boolean")
    df = dashboard.aircraft_utilization(derive_star(spark, lines).with_tables(fact_flight=flights, aircraft=aircraft))
    assert len([x for x in exchanges(df) if "DateKey" in x]) == 1
    got = {(r.TailNumber, r.Model): (r.DaysOperated, r.TotalFlights, r.TotalFlightHours, round(float(r.AvgLoadFactor), 6))
           for r in df.collect()}
    assert got == {("N1", "M"): (2, 4, 2.0, 50.0), (None, "M"): (0, 2, 0.5, 10.0)}
