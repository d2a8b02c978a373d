from decimal import Decimal

from aerostar.operators.etl import apply_defaults, transform_flights

COLS = ("FlightFactKey long, FlightKey long, DateKey int, AircraftKey long, "
        "DepartureAirportKey int, ArrivalAirportKey int, CarrierKey int, "
        "DepartureDelayMin int, ArrivalDelayMin int, SeatsAvailable int, SeatsFilled int")


def test_transform_and_reject_reasons(spark):
    rows = [
        (1, 1, 20240101, 1, 1, 2, 1, 0, 15, 200, 150),     # valid, on time
        (2, None, 20240101, 1, 1, 2, 1, 0, 16, 200, 150),  # missing FlightKey
        (3, 1, 20240101, 1, 1, 2, 1, 0, 0, 0, 0),          # zero seats
        (4, 1, 20240101, 1, 1, 2, 1, 0, 0, 100, 120),      # filled > available
        (5, 1, 20240101, 1, 1, 2, 1, 0, None, 120, 120),   # equal seats valid, NULL delay: 0
        (6, 1, 20240101, 1, 1, 2, 1, 0, 0, 3, 1),          # 33.333.. -> 33.33
    ]
    valid, rejected = transform_flights(spark.createDataFrame(rows, COLS))
    v = {r.FlightFactKey: r for r in valid.collect()}
    assert sorted(v) == [1, 5, 6]
    assert v[1].LoadFactor == Decimal("75.00") and v[1].OnTimeFlag is True
    assert v[5].LoadFactor == Decimal("100.00") and v[5].OnTimeFlag is True  # the default
    assert v[6].LoadFactor == Decimal("33.33")
    reasons = {r.FlightFactKey: r.RejectReason for r in rejected.collect()}
    assert reasons == {2: "missing_FlightKey", 3: "no_seats_available",
                       4: "seats_filled_exceed_available"}


def test_defaults(spark):
    df = spark.createDataFrame([(None, None, None)],
                               "DepartureDelayMin int, ArrivalDelayMin int, CancellationFlag boolean")
    r = apply_defaults(df).first()
    assert (r.DepartureDelayMin, r.ArrivalDelayMin, r.CancellationFlag) == (0, 0, False)


def test_maintenance_derivation(spark):
    import datetime as dt
    from aerostar.operators.etl import derive_maintenance
    src = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 8, 0), dt.datetime(2024, 1, 1, 11, 30), Decimal("100.10"),
          Decimal("50.05"))],
        "start_time timestamp, end_time timestamp, labor_cost decimal(10,2), parts_cost decimal(10,2)")
    r = derive_maintenance(src).first()
    assert r.DurationHours == Decimal("3.50") and r.TotalCost == Decimal("150.15")


def test_lookup_and_range_rejects(spark):
    from aerostar.operators.etl import lookup_keys, reject_load_factor_range
    dim = spark.createDataFrame([("C1", 1, True), ("C1", 0, False), ("C2", 2, True)],
                                "CustomerID string, CustomerKey int, IsCurrent boolean")
    src = spark.createDataFrame([(10, "C1"), (11, "C3")], "b int, cid string")
    hits, misses = lookup_keys(src, dim, "cid", "CustomerID", "CustomerKey")
    assert [(r.b, r.CustomerKey) for r in hits.collect()] == [(10, 1)]
    assert [(r.b, r.RejectReason) for r in misses.collect()] == [(11, "unknown_cid")]
    lf = spark.createDataFrame([(1, Decimal("50.00")), (2, Decimal("100.01")), (3, None)],
                               "k int, LoadFactor decimal(5,2)")
    ok, bad = reject_load_factor_range(lf)
    assert sorted(r.k for r in ok.collect()) == [1, 3] and [r.k for r in bad.collect()] == [2]


def test_etl_run_optional_scd2_step(spark, wh):
    from aerostar.plans.etl_jobs import run_etl
    from aerostar.sources.batches import customer_batch, flight_batch
    from aerostar.sources.star import read_table
    from conftest import SMALL
    out = run_etl(wh, flight_batch(read_table(spark, SMALL, "lineitem")),
                  customer_batch=customer_batch(read_table(spark, SMALL, "customer")))
    assert set(out) >= {"extracted", "valid", "rejected", "fact_flight", "dq", "dim_customer"}
    assert out["dq"].count() == 3
    assert out["dim_customer"].filter("IsCurrent").count() >= wh.customer.filter("IsCurrent").count()


def test_dq_required_defaults_counts(spark):
    from aerostar.operators.quality import dq_required_defaults
    df = spark.createDataFrame(
        [(1, 20240101, 1, 1, 2, None, 5, None), (None, 20240101, 1, 1, 2, 0, None, False),
         (2, 20240101, 1, 1, 2, 0, 0, True)],
        "FlightKey long, DateKey int, AircraftKey long, DepartureAirportKey int, "
        "ArrivalAirportKey int, DepartureDelayMin int, ArrivalDelayMin int, CancellationFlag boolean")
    got = {r.CheckName: r.Failures for r in dq_required_defaults(df).collect()}
    assert got == {"missing_required_keys": 1, "defaulted_DepartureDelayMin": 1,
                   "defaulted_ArrivalDelayMin": 1, "defaulted_CancellationFlag": 1}


def test_all_keys_of_a_record(spark):
    from aerostar.operators.etl import Lookup, resolve_keys, split_resolved
    planes = spark.createDataFrame([("N1", 1, True), ("N1", 2, True), ("N2", 3, False)], "TailNumber string, AircraftKey int, IsCurrent boolean")
    airports = spark.createDataFrame([("A01", 1), ("A02", 2)], "IATA string, AirportKey int")
    src = spark.createDataFrame([(1, "N1", "A01", "A02"), (2, "N2", "A09", "A01"), (3, None, None, "A08"), (3, None, None, "A08"),
                                 (4, "N9", "A02", "A02")], "id int, tail string, origin string, target string")
    lookups = [Lookup("tail", planes, "TailNumber", "AircraftKey", "AircraftKey"),
               Lookup("origin", airports, "IATA", "AirportKey", "FromKey"), Lookup("target", airports, "IATA", "AirportKey", "ToKey")]
    done = resolve_keys(src, lookups)
    assert done.columns == ["id", "tail", "origin", "target", "AircraftKey", "FromKey", "ToKey", "RejectReasons"]
    hits, misses = split_resolved(done)
    # The highest of two current versions; no row is doubled.
    assert [(r.id, r.AircraftKey, r.FromKey, r.ToKey) for r in hits.collect()] == [(1, 2, 1, 2)]
    three = ["missing_tail", "missing_origin", "unknown_target"]
    assert sorted((r.id, r.RejectReasons) for r in misses.collect()) == [
        (2, ["unknown_tail", "unknown_origin"]), (3, three), (3, three), (4, ["unknown_tail"])]
    assert split_resolved(resolve_keys(src.limit(0), lookups))[1].count() == 0


def test_children_without_parts(spark):
    from pyspark.sql import functions as F

    from aerostar.sources.batches import maintenance_costs
    log = spark.createDataFrame([(4, "error", 10.5), (5, "error", 10.5), (7, "error", 1.25), (6, "view", 1.0)],
                                "event_id long, event_type string, value double")
    lines = sorted(tuple(r) for r in maintenance_costs(log).select(
        "event_id", F.col("labor_cost").cast("double"), F.col("parts_cost").cast("double")).collect())
    assert lines[0] == (5, 11.5, 25.0) and lines[1:] == [(7, 2.25, 25.0), (7, 3.25, 50.0), (7, 4.25, None)]
