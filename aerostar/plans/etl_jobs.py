"""ETL run (E08) and the registered ETL / data-quality jobs that read raw tables."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostar.functions.dates import DEFAULT_AS_OF, days_before, key_of
from aerostar.operators import quality as Q
from aerostar.operators.etl import (Lookup, aggregate_children, as_report, derive_booking_totals,
                                    derive_delays, derive_maintenance,
                                    reject_load_factor_range, resolve_keys, transform_flights,
                                    validate_flights, weather_match, with_key)
from aerostar.operators.scd2 import (CUSTOMER_TRACKED, CUSTOMER_VERSION_COLS, point_in_time,
                                     scd2_apply)
from aerostar.operators.upsert import insert_if_absent, upsert_facts
from aerostar.registry import raw_job
from aerostar.session import checkpoint_dir
from aerostar.sources.batches import (EXTRACT_END, EXTRACT_START, SEVERITY_MAP, aircraft_register, arrivals, booking_codes, booking_source,
                                      customer_batch, flight_batch, flight_departures, flight_events,
                                      flight_key, flight_source, maintenance_codes, maintenance_costs,
                                      maintenance_events, weather_observations)
from aerostar.sources.catalog import FLIGHT_RECORD, rule_counts
from aerostar.sources.extract import extract_window
from aerostar.sources.star import MONTH_PART, Warehouse, _airport_keys, derive_star, flight_base, read_table, stage_star
from aerostar.streaming.incremental import stream_increments


def run_etl(wh: Warehouse, batch: DataFrame, as_of: dt.date = DEFAULT_AS_OF,
            window_days: int = 7, customer_batch: DataFrame | None = None) -> dict[str, DataFrame]:
    """Extract the last ``window_days`` of the batch, transform, upsert, check.

    Returns every stage as a lazy DataFrame; nothing is collected between
    steps (the caller writes ``fact_flight`` and reads the small ``dq``).
    The SCD2 customer step, which the original's main does not call, runs
    when a ``customer_batch`` is given (result ``dim_customer``).
    """
    lo, hi = key_of(days_before(as_of, window_days)), key_of(as_of)
    extracted = batch.filter(F.col("DateKey").between(lo, hi))
    valid, rejected = transform_flights(extracted)
    loaded = upsert_facts(wh.fact_flight, valid, seq="seq")
    dq = Q.dq_report(wh.with_tables(fact_flight=loaded), as_of)
    out = {"extracted": extracted, "valid": valid, "rejected": rejected,
           "fact_flight": loaded, "dq": dq}
    if customer_batch is not None:
        out["dim_customer"] = scd2_apply(wh.customer, customer_batch, as_of=as_of)
    return out


LOADS_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("folder", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("rows_loaded", T.LongType()), T.StructField("failed_checks", T.StringType()),
])


def loads(spark: SparkSession, table: str) -> DataFrame:
    """The append-only list of loads: version, folder, status (published or withheld), rows and failed checks."""
    path = f"{table.rstrip('/')}/loads"
    try:
        return spark.read.schema(LOADS_SCHEMA).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":  # anything but "no load yet"
            raise
        return spark.createDataFrame([], LOADS_SCHEMA)


def read_load(spark: SparkSession, table: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The facts of the last published load, or of ``version``; a load that was withheld is never read."""
    found = loads(spark, table).filter(F.col("status") == "published")
    if version is not None:
        found = found.filter(F.col("version") == version)
    folder = found.agg(F.max_by("folder", "version")).first()[0]
    if folder is None:
        raise ValueError(f"no published load in {table}")
    return spark.read.schema(schema).parquet(f"{table.rstrip('/')}/{folder}")


def load_flights(wh: Warehouse, batch: DataFrame, table: str, as_of: dt.date = DEFAULT_AS_OF, window_days: int = 7,
                 allowed: dict[str, float] | None = None) -> dict:
    """E08 with a stored result: the loaded facts are written once, the written rows checked in one scan, then
    published or withheld.

    Every load has a folder of its own, which readers see only once its row in
    ``loads`` says published. ``allowed`` gives for each check the share of the
    rows that may fail it (default: any number, as the original only warns); a
    load over a limit is listed as withheld, so the load before stays the
    current one. A failure on the way leaves a folder that nothing lists.
    One writer at a time.
    """
    spark = batch.sparkSession
    loaded = run_etl(wh, batch, as_of, window_days)["fact_flight"]
    version = (loads(spark, table).agg(F.max("version")).first()[0] or 0) + 1
    folder = f"data/{version}-{uuid.uuid4().hex}"
    seen = Observation(f"load-{folder}")
    loaded.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{table.rstrip('/')}/{folder}")
    written = spark.read.schema(loaded.schema).parquet(f"{table.rstrip('/')}/{folder}")
    checks = {r.CheckName: r.Failures for r in Q.dq_report(wh.with_tables(fact_flight=written), as_of).collect()}
    rows = seen.get["n"]
    over = sorted(c for c, share in (allowed or {}).items() if checks[c] > share * rows)
    entry = (version, folder, "withheld" if over else "published", rows, ",".join(over))
    (spark.createDataFrame([entry], LOADS_SCHEMA).coalesce(1)
     .write.mode("append").parquet(f"{table.rstrip('/')}/loads"))
    return dict(zip(LOADS_SCHEMA.names, entry, strict=True)) | {"checks": checks}


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flight_batch(read_table(spark, sf_dir, "lineitem"))


def _keyed_batch(lines: DataFrame) -> DataFrame:
    """The flight batch dealt by its key while a record is still a line: a third of the columns of a record with
    its ``seq``. What groups or joins the records by their key moves them no more."""
    return flight_batch(lines.repartition(flight_key()))


def _keyed_star(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse, its flights dealt by their key before their many columns are derived."""
    return derive_star(spark, sf_dir, flight_base(read_table(spark, sf_dir, "lineitem")).repartition("k"))


@raw_job("flight_transform")
def flight_transform(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Valid flight records with LoadFactor and OnTimeFlag."""
    valid, _ = transform_flights(_batch(spark, sf_dir))
    return as_report(valid.drop("seq"))


@raw_job("flight_validate")
def flight_validate(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Rejected flight records with their reason."""
    checked = validate_flights(_batch(spark, sf_dir).drop("seq"))
    return as_report(checked.filter(F.col("RejectReason").isNotNull()))


@raw_job("flight_upsert")
def flight_upsert(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """All stored facts, upserted with the full batch; both are dealt by the key once."""
    wh = wh or _keyed_star(spark, sf_dir)
    valid, _ = transform_flights(_keyed_batch(read_table(spark, sf_dir, "lineitem")))
    return as_report(upsert_facts(wh.fact_flight, valid, seq="seq"))


@raw_job("customer_scd2")
def customer_scd2(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """The customer dimension after the daily CRM snapshot."""
    wh = wh or derive_star(spark, sf_dir)
    batch = customer_batch(read_table(spark, sf_dir, "customer"))
    return scd2_apply(wh.customer, batch)


@raw_job("customer_scd2_phone")
def customer_scd2_phone(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """As E04, with Phone tracked (and written) as the document asks."""
    wh = wh or derive_star(spark, sf_dir)
    batch = customer_batch(read_table(spark, sf_dir, "customer"), with_phone=True)
    return scd2_apply(wh.customer, batch, tracked=list(CUSTOMER_TRACKED) + ["Phone"],
                      version_cols=list(CUSTOMER_VERSION_COLS) + ["Phone"])


@raw_job("insert_if_absent")
def seed_flights(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Seed every scheduled flight of the part table, skipping existing keys."""
    wh = wh or derive_star(spark, sf_dir)
    part = read_table(spark, sf_dir, "part")
    return insert_if_absent(wh.flight, _all_flights(part), "FlightKey", seq="FlightKey")


def _all_flights(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    return part.select(pk.alias("FlightKey"),
                       F.concat(F.lit("FL"), (1000 + pk).cast("string")).alias("FlightNumber"),
                       (pk % 5).cast("int").alias("CarrierKey"), *_airport_keys(pk))


@raw_job("extract_window")
def extract_events(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """The last week of the event log."""
    return extract_window(read_table(spark, sf_dir, "events"), "ts", EXTRACT_START, EXTRACT_END)


@raw_job("etl_run")
def etl_run(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Data-quality report after loading the last week of the flight batch."""
    wh = wh or derive_star(spark, sf_dir)
    return run_etl(wh, _batch(spark, sf_dir))["dq"]


@raw_job("etl_load")
def etl_load(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """All facts after loading the last week of the batch, read back from the published load."""
    wh = wh or derive_star(spark, sf_dir)
    table = f"{checkpoint_dir(spark).rstrip('/')}/loads/{uuid.uuid4().hex}"
    batch, schema = _batch(spark, sf_dir), wh.fact_flight.drop(MONTH_PART).schema
    plain = wh.with_tables(fact_flight=wh.fact_flight.drop(MONTH_PART))
    load_flights(plain, batch, table)
    return as_report(read_load(spark, table, schema))


@raw_job("booking_totals")
def booking_totals(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Reservation records with TotalAmount and CancellationFlag."""
    return as_report(derive_booking_totals(booking_source(read_table(spark, sf_dir, "orders"))))


@raw_job("booking_key_lookup")
def booking_key_lookup(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Reservation customer IDs resolved to current customer keys; misses carry a reason."""
    wh = wh or derive_star(spark, sf_dir)
    src = booking_source(read_table(spark, sf_dir, "orders")).select("booking_id", "customer_id")
    return with_key(src, wh.customer, "customer_id", "CustomerID", "CustomerKey")


def _resolved(df: DataFrame) -> DataFrame:
    """The reasons as one text, for registered output."""
    return df.withColumn("RejectReasons", F.when(F.col("RejectReasons").isNotNull(), F.concat_ws(",", "RejectReasons")))


@raw_job("flight_keys")
def flight_keys(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Flight records with their flight, airport and aircraft keys, every miss of a record in one list."""
    wh = wh or derive_star(spark, sf_dir)
    return _resolved(resolve_keys(flight_source(read_table(spark, sf_dir, "lineitem")), [
        Lookup("flight_number", wh.flight, "FlightNumber", "FlightKey", "FlightKey"),
        Lookup("departure_airport", wh.airport, "IATA", "AirportKey", "DepartureAirportKey"),
        Lookup("arrival_airport", wh.airport, "IATA", "AirportKey", "ArrivalAirportKey"),
        Lookup("tail_number", wh.aircraft, "TailNumber", "AircraftKey", "AircraftKey")]))


@raw_job("booking_keys")
def booking_keys(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Reservations with their customer, flight and fare class keys, every miss in one list."""
    wh = wh or derive_star(spark, sf_dir)
    return _resolved(resolve_keys(booking_codes(read_table(spark, sf_dir, "orders")), [
        Lookup("customer_id", wh.customer, "CustomerID", "CustomerKey", "CustomerKey"),
        Lookup("flight_number", wh.flight, "FlightNumber", "FlightKey", "FlightKey"),
        Lookup("fare_code", wh.fare_class, "FareCode", "FareClassKey", "FareClassKey")]))


@raw_job("maintenance_keys")
def maintenance_keys(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Maintenance events with their aircraft and type keys, every miss in one list."""
    wh = wh or derive_star(spark, sf_dir)
    return _resolved(resolve_keys(maintenance_codes(read_table(spark, sf_dir, "events")), [
        Lookup("tail_number", wh.aircraft, "TailNumber", "AircraftKey", "AircraftKey"),
        Lookup("maintenance_type", wh.maintenance_type, "MaintenanceCode", "MaintenanceTypeKey", "MaintenanceTypeKey")]))


@raw_job("maintenance_costs")
def maintenance_cost_totals(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Labor and parts summed per maintenance event; an event without cost lines has none, without parts 0 of them."""
    log = read_table(spark, sf_dir, "events")
    totals = aggregate_children(maintenance_codes(log).select("event_id"), maintenance_costs(log), "event_id", {
        "LaborCost": F.sum("labor_cost"), "PartsCost": F.coalesce(F.sum("parts_cost"), F.lit(0).cast("decimal(20,2)")),
        "CostLines": F.count(F.lit(1))})
    return as_report(totals.withColumn("TotalCost", (F.col("LaborCost") + F.col("PartsCost")).cast("decimal(20,2)")))


@raw_job("dq_duplicates")
def dq_duplicate_flights(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """FlightFactKeys that occur more than once in the flight batch."""
    return Q.dq_duplicates(_batch(spark, sf_dir), "FlightFactKey")


@raw_job("booking_customer_version")
def booking_customer_version(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Each reservation with the customer version valid on its travel date.

    The history is the customer dimension after the daily snapshot (E04), so
    travel dates from the snapshot day on see the new versions.
    """
    wh = wh or derive_star(spark, sf_dir)
    history = scd2_apply(wh.customer, customer_batch(read_table(spark, sf_dir, "customer")))
    src = booking_source(read_table(spark, sf_dir, "orders")).select(
        "booking_id", "customer_id", "travel_date")
    return point_in_time(src, history, "customer_id", "CustomerID", "travel_date",
                         ["CustomerKey", "LoyaltyTier"])


#: The day of the aircraft register.
REGISTER_DAY = dt.date(2024, 7, 1)


@raw_job("maintenance_aircraft_version")
def maintenance_aircraft_version(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """P06 for aircraft: each maintenance event with the version of its aircraft that was valid on its day.

    The history is the aircraft dimension after the register (E04 on the tail
    number); events from its day on see the new owner.
    """
    wh = wh or derive_star(spark, sf_dir)
    history = scd2_apply(wh.aircraft, aircraft_register(read_table(spark, sf_dir, "supplier")), "TailNumber", ["OwnershipType"],
                         REGISTER_DAY, "AircraftKey", version_cols=["TailNumber", "OwnershipType"], carry_forward=True)
    log, day = read_table(spark, sf_dir, "events"), F.date_add(F.to_date("ts"), ((F.col("event_id") % 12) * 30).cast("int"))
    jobs = maintenance_codes(log.withColumn("day", day), "day").withColumnRenamed("day", "MaintenanceDate").drop("maintenance_type")
    return point_in_time(jobs, history, "tail_number", "TailNumber", "MaintenanceDate", ["AircraftKey", "OwnershipType", "Manufacturer"])


@raw_job("load_rules")
def load_rules(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """How many records of the batch and of the stored facts each rule of a flight record rejects, fills or lets pass."""
    wh = wh or derive_star(spark, sf_dir)
    return rule_counts(_batch(spark, sf_dir), "FlightBatch", FLIGHT_RECORD).unionByName(
        rule_counts(wh.fact_flight, "FactFlight", FLIGHT_RECORD))


@raw_job("booking_points")
def booking_points(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Loyalty points summed per booking from its transactions.

    The order lines play the loyalty transactions of a reservation (one
    point per unit of quantity); they are summed per booking before the join,
    so the join sees one row per booking.
    """
    src = booking_source(read_table(spark, sf_dir, "orders")).select("booking_id", "customer_id")
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("booking_id"),
        F.floor("l_quantity").cast("long").alias("points_earned"))
    return aggregate_children(src, lines, "booking_id", {
        "LoyaltyPointsEarned": F.sum("points_earned"),
        "Transactions": F.count(F.lit(1)),
    })


@raw_job("load_factor_rejects")
def load_factor_rejects(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Transformed flight records whose LoadFactor is outside 0..100."""
    valid, _ = transform_flights(_batch(spark, sf_dir))
    _, bad = reject_load_factor_range(valid.drop("seq"))
    return as_report(bad)


@raw_job("flight_upsert_stream")
def flight_upsert_stream(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """P09 + P10 on the real tables: all flight facts are committed as the
    first version of a month table; the raw line items then arrive as a file
    stream (``Trigger.AvailableNow``) in two arrivals, the first record of
    each key, then the later ones, so the second micro-batch brings late
    updates. Every micro-batch is transformed
    (E01) and commits the months that it touches as a new version. The last
    version equals the batch upsert E03. It is kept in a fresh folder under
    the shared checkpoint folder, from which the returned DataFrame reads.
    """
    import uuid

    from aerostar.streaming.months import MONTH, commit, read_months, upsert_months

    work = f"{checkpoint_dir(spark).rstrip('/')}/flight_upsert_stream/{uuid.uuid4().hex}"
    table = f"{work}/fact_flight"
    lines, dealt = read_table(spark, sf_dir, "lineitem"), wh is None
    # The seed is dealt by month before the many columns of a fact are derived.
    wh = wh or derive_star(spark, sf_dir, flight_base(lines).withColumn(MONTH, F.date_trunc("month", "d")).hint("rebalance", MONTH))
    seed = wh.fact_flight.drop(MONTH_PART).withColumn(MONTH, (F.col("DateKey") / 100).cast("int"))
    commit(table, seed, -1, dealt=dealt)

    def apply(micro_batch: DataFrame, batch_id: int) -> None:
        valid, _ = transform_flights(_keyed_batch(micro_batch))
        upsert_months(table, valid, batch_id, seed.schema)

    arrivals(lines.repartition(flight_key())).write.partitionBy("arrival").parquet(f"{work}/outbox")
    for n in (1, 2):
        spark.read.schema(lines.schema).parquet(f"{work}/outbox/arrival={n}").write.parquet(f"{work}/lineitem/{n}")
        # A run for each arrival: a schedule's runs, each of which takes the files that are new.
        stream_increments(spark, f"{work}/lineitem/*", lines.schema, f"{work}/_stream_checkpoint", apply).awaitTermination()
    return as_report(read_months(spark, table, seed.schema).drop(MONTH))


@raw_job("flight_delays")
def flight_delays(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Departure and arrival delay minutes from actual vs scheduled times."""
    events = flight_events(read_table(spark, sf_dir, "lineitem"))
    return derive_delays(events).select("FlightFactKey", "DepartureDelayMin", "ArrivalDelayMin")


@raw_job("maintenance_derivation")
def maintenance_derivation(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """DurationHours from start/end and TotalCost = labor + parts."""
    events = maintenance_events(read_table(spark, sf_dir, "events"))
    return as_report(derive_maintenance(events).select(
        "event_id", "tail_number", "labor_cost", "parts_cost", "DurationHours", "TotalCost"))


@raw_job("flight_weather")
def flight_weather(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Each flight with the weather observed at its departure airport and hour."""
    wh = wh or derive_star(spark, sf_dir)
    flights = flight_departures(read_table(spark, sf_dir, "lineitem"))
    obs = weather_observations(read_table(spark, sf_dir, "events"))
    return (weather_match(flights, obs, wh.weather, SEVERITY_MAP)
            .select("FlightFactKey", "departure_airport", "WeatherKey"))


@raw_job("mart_refresh")
def mart_refresh(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """E10 end to end: refresh all five marts into a new version, publish it,
    and read the monthly flight summary back through the version pointer."""
    import uuid

    from aerostar.plans.marts import current_mart, refresh_marts

    out = f"{checkpoint_dir(spark).rstrip('/')}/marts/{uuid.uuid4().hex}"
    wh = wh or stage_star(spark, sf_dir, out)  # the marts read the flights many times
    refresh_marts(wh, out, DEFAULT_AS_OF.strftime("%Y%m%d"))
    return current_mart(spark, out, "mv_monthly_flight_summary")


@raw_job("mart_rows")
def mart_rows(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """E10 for all marts: refreshed twice under one label, the first refresh read back by a reader pinned to it."""
    import uuid

    from aerostar.plans.marts import MARTS, current_mart, mart_versions, refresh_marts

    out = f"{checkpoint_dir(spark).rstrip('/')}/marts/{uuid.uuid4().hex}"
    wh = wh or stage_star(spark, sf_dir, out)  # the marts read the flights many times
    label = DEFAULT_AS_OF.strftime("%Y%m%d")
    refresh_marts(wh, out, label)
    pinned = mart_versions(spark, out)[-1]
    held = [current_mart(spark, out, name, pinned).agg(F.lit(name).alias("Mart"), F.count(F.lit(1)).alias("Rows")) for name in MARTS]
    refresh_marts(wh, out, label)
    return reduce(DataFrame.unionByName, held)


@raw_job("etl_audit")
def etl_audit(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Load the transformed flight batch with an audit trail; returns the run's entry of the audit log."""
    import uuid

    from aerostar.operators.audit import audited_upsert
    from aerostar.operators.upsert import FLIGHT_INSERT_COLS, FLIGHT_UPDATE_COLS

    wh = wh or _keyed_star(spark, sf_dir)
    work = f"{checkpoint_dir(spark).rstrip('/')}/audit/{uuid.uuid4().hex}"
    valid, _ = transform_flights(_keyed_batch(read_table(spark, sf_dir, "lineitem")))
    _, rejected = transform_flights(_batch(spark, sf_dir))
    audited_upsert(spark, "flight_load", wh.fact_flight.select("FlightFactKey"), valid, rejected, f"{work}/load", f"{work}/logs",
                   "FlightFactKey", FLIGHT_UPDATE_COLS, FLIGHT_INSERT_COLS, "seq", "DateKey")
    return spark.read.parquet(f"{work}/logs/etl_audit_log").select(
        "job", (F.col("rows_processed") - F.col("rows_rejected")).alias("rows_written"), "rows_processed", "rows_inserted",
        "rows_updated", "rows_rejected", "watermark_key", "watermark_id", "status")


# Cut-off of the first extract run in the high-water example.
FIRST_RUN_END = EXTRACT_START


@raw_job("incremental_events")
def incremental_events(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """P09 batch form: a first run extracts the event log up to a cut-off and
    records its high-water mark in a control table; the next run extracts
    only the events newer than that mark."""
    import datetime as _dt
    import uuid

    from aerostar.streaming.incremental import (high_water_extract, init_control, read_control,
                                                record_watermark)

    control = f"{checkpoint_dir(spark).rstrip('/')}/control/{uuid.uuid4().hex}"
    init_control(spark, control)
    events = read_table(spark, sf_dir, "events")
    first = high_water_extract(events.filter(F.col("ts") < F.lit(FIRST_RUN_END)),
                               read_control(spark, control), "events", "ts")
    record_watermark(first, control, "events", "ts", _dt.datetime(2024, 1, 24), "event_id")
    return high_water_extract(events, read_control(spark, control), "events", "ts", "event_id")


@raw_job("dq_required_defaults")
def dq_required_defaults_job(spark: SparkSession, sf_dir: str, wh: Warehouse | None = None) -> DataFrame:
    """Required keys and documented defaults over the flight batch."""
    return Q.dq_required_defaults(_batch(spark, sf_dir))
