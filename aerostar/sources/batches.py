"""ETL input batches derived from the driver's tables (FIXTURES.md section 4).

* flight batch: one row per raw lineitem row (keys repeat, so the upsert has
  duplicates to resolve); its order inside a key is the order of the other
  columns, carried as a struct ``seq`` -- no window, no global sort.
* customer batch: a daily CRM snapshot of every customer, whose tier and
  e-mail follow the CRM's own rules and therefore differ from the warehouse
  for part of the customers; customers without a current version are new.
* booking source: reservation records with business keys (P03, P05).
* weather observations (P08): hourly readings per airport from the event log.
* flight events (P01) and maintenance events (P04): operational records
  with times and cost parts, consistent with the facts derived from the
  same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostar.functions.dates import date_key
from aerostar.sources.star import SHIFT_DAYS, _airport_keys, _text

FLIGHT_BATCH_COLS = (
    "FlightFactKey", "FlightKey", "DateKey", "AircraftKey", "DepartureAirportKey",
    "ArrivalAirportKey", "CarrierKey", "DepartureDelayMin", "ArrivalDelayMin",
    "SeatsAvailable", "SeatsFilled", "Revenue", "FuelCost", "DistanceMiles", "CancellationFlag",
)


def flight_key() -> F.Column:
    """Key of a batch record; every 50th order brings flights that no stored fact has (negative keys)."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return F.when(F.col("l_orderkey") % 50 == 0, -key).otherwise(key)


# Fixed values: (modulus, remainder) of the orders whose records are bad or incomplete.
BAD_RECORDS = {
    "no_flight": (499, 3), "no_aircraft": (503, 5), "overfull": (509, 7), "no_seats": (521, 11),
    "no_departure_delay": (523, 13), "no_arrival_delay": (541, 17), "no_cancellation": (547, 19), "negative_seats": (557, 23),
}


def _unless(rule: str, value, bad=None):
    """``value``, in the records of a bad order ``bad`` (default: null)."""
    modulus, rest = BAD_RECORDS[rule]
    return F.when(F.col("l_orderkey") % modulus == rest, F.lit(None) if bad is None else bad).otherwise(value)


def flight_batch(lineitem: DataFrame, *carried: str) -> DataFrame:
    """Flight records as they arrive, some bad or incomplete (BAD_RECORDS); ``carried`` columns go along."""
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    q = F.floor("l_quantity").cast("int")
    d = F.date_add(F.to_date("l_shipdate"), SHIFT_DAYS)
    seats = (F.lit(150) + pk % 200).cast("int")
    rows = lineitem.select(
        flight_key().alias("FlightFactKey"),
        _unless("no_flight", pk).alias("FlightKey"),
        date_key(d).alias("DateKey"),
        _unless("no_aircraft", sk).alias("AircraftKey"),
        *_airport_keys(pk),
        (sk % 5).cast("int").alias("CarrierKey"),
        _unless("no_departure_delay", q - 5).alias("DepartureDelayMin"),
        _unless("no_arrival_delay", q * 2 - 10).alias("ArrivalDelayMin"),
        _unless("no_seats", seats, F.lit(0)).alias("SeatsAvailable"),
        _unless("overfull", _unless("negative_seats", seats - q, F.lit(-4)), seats + 3).cast("int").alias("SeatsFilled"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("Revenue"),
        (q * 500).cast("decimal(10,2)").alias("FuelCost"),
        (F.lit(200) + pk % 2800).cast("int").alias("DistanceMiles"),
        _unless("no_cancellation", F.col("l_discount") >= 0.095).alias("CancellationFlag"),
        *carried,
    )
    return rows.withColumn("seq", F.struct(*[F.col(c) for c in FLIGHT_BATCH_COLS[1:]]))


def arrivals(lineitem: DataFrame) -> DataFrame:
    """The lines with ``arrival``: 1 for the first of each batch key in the order of its records, else 2."""
    named = flight_batch(lineitem.withColumn("_line", F.struct(*lineitem.columns)), "_line")
    nth = F.row_number().over(Window.partitionBy("FlightFactKey").orderBy("seq"))
    return named.withColumn("arrival", F.when(nth == 1, 1).otherwise(2)).select("_line.*", "arrival")


def crm_tier(balance) -> F.Column:
    """The CRM's tier rule: bands of account balance."""
    return (F.when(balance >= 7500, "Platinum").when(balance >= 5000, "Gold")
            .when(balance >= 2500, "Silver").otherwise("Bronze"))


def customer_batch(customer: DataFrame, with_phone: bool = False) -> DataFrame:
    ck, bal = F.col("c_custkey"), F.col("c_acctbal")
    cols = [
        F.lit(1).cast("long").alias("seq"),
        _text("CUST", 10000 + ck).alias("CustomerID"),
        _text("F", ck % 50).alias("FirstName"),
        F.col("c_name").alias("LastName"),
        F.concat(F.col("c_name"), F.when(bal < 0, F.lit("@y.org")).otherwise(F.lit("@x.org")))
        .alias("Email"),
        crm_tier(bal).alias("LoyaltyTier"),
        (F.floor(F.abs(bal)) + 1).cast("int").alias("LoyaltyPoints"),
    ]
    if with_phone:
        cols.append(_text("+1-555-", 1000 + (ck + F.col("c_nationkey")) % 9000).alias("Phone"))
    return customer.select(*cols)


def booking_source(orders: DataFrame) -> DataFrame:
    ok = F.col("o_orderkey")
    status = (F.when(F.col("o_orderstatus") == "F", "CONFIRMED")
              .when(F.col("o_orderstatus") == "O", "TICKETED")
              .when(ok % 2 == 0, "CANCELLED").otherwise("REFUNDED"))
    return orders.select(
        ok.alias("booking_id"),
        _text("CUST", 10000 + F.col("o_custkey")).alias("customer_id"),
        (ok % 200).cast("int").alias("flight_id"),
        F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS).alias("travel_date"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("base_fare"),
        F.lit(10).cast("decimal(8,2)").alias("taxes"),
        F.lit(5).cast("decimal(8,2)").alias("fees"),
        status.alias("booking_status"),
    )


def flight_source(lineitem: DataFrame) -> DataFrame:
    """Flight records with business keys (P05): number, airports and tail number, some of them absent (BAD_RECORDS)."""
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    departure, arrival = _airport_keys(pk)
    return lineitem.select(
        flight_key().alias("FlightFactKey"),
        _unless("no_flight", _text("FL", 1000 + pk)).alias("flight_number"),
        airport_code(departure).alias("departure_airport"),
        airport_code(arrival).alias("arrival_airport"),
        _unless("no_aircraft", _text("N", 1000 + sk)).alias("tail_number"))


def booking_codes(orders: DataFrame) -> DataFrame:
    """Reservations with their three business keys (P05); one fare code in six is not known."""
    ok = F.col("o_orderkey")
    return orders.select(
        ok.alias("booking_id"), _text("CUST", 10000 + F.col("o_custkey")).alias("customer_id"),
        _text("FL", 1000 + ok % 200).alias("flight_number"), _text("R", ok % 6).alias("fare_code"))


def maintenance_codes(events: DataFrame, *carried: str) -> DataFrame:
    """Maintenance events with their business keys (P05); one type in five is not known; ``carried`` columns go along."""
    eid = F.col("event_id")
    return events.filter(F.col("event_type") == "error").select(
        eid.alias("event_id"), _text("N", 1000 + F.col("user_id") % 10).alias("tail_number"),
        _text("MT", eid % 5).alias("maintenance_type"), *carried)


def aircraft_register(supplier: DataFrame) -> DataFrame:
    """The register of the aircraft in service (P06): ownership follows the lessor's balance, so some have changed hands."""
    sk = F.col("s_suppkey")
    return supplier.filter(sk % 10 != 9).select(
        F.lit(1).cast("long").alias("seq"), _text("N", 1000 + sk).alias("TailNumber"),
        F.when(F.col("s_acctbal") < 0, "Leased").otherwise("Owned").alias("OwnershipType"))


def maintenance_costs(events: DataFrame) -> DataFrame:
    """Cost lines of the maintenance events (P07), none to three an event: hours of labor and parts."""
    eid, n = F.col("event_id"), F.col("line")
    value = F.col("value").cast("decimal(10,2)")
    lines = events.filter((F.col("event_type") == "error") & (eid % 4 > 0)).withColumn(
        "line", F.explode(F.sequence(F.lit(1), (eid % 4).cast("int"))))
    return lines.select(eid.alias("event_id"), (value + n).cast("decimal(10,2)").alias("labor_cost"),
                        F.when(n < 3, n * 25).cast("decimal(10,2)").alias("parts_cost"))


# Window of the extract example: the last 7 days of the event log.
EXTRACT_START = dt.datetime(2024, 1, 24, 0, 0, 0)
EXTRACT_END = dt.datetime(2024, 1, 31, 0, 0, 0)


def flight_events(lineitem: DataFrame) -> DataFrame:
    """Operational flight events (P01 source): scheduled and actual times.

    Scheduled departure is the shifted ship date plus ``partkey % 24`` hours,
    scheduled arrival adds the air time; the actual times differ by the
    delays the fact table carries, so P01 must reproduce them.
    """
    pk = F.col("l_partkey")
    q = F.floor("l_quantity").cast("long")
    day = F.unix_timestamp(F.date_add(F.to_date("l_shipdate"), SHIFT_DAYS).cast("timestamp"))
    dep = day + (pk % 24) * 3600
    arr = dep + (30 + pk % 300) * 60
    return lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("FlightFactKey"),
        F.timestamp_seconds(dep).alias("scheduled_departure"),
        F.timestamp_seconds(dep + (q - 5) * 60).alias("actual_departure"),
        F.timestamp_seconds(arr).alias("scheduled_arrival"),
        F.timestamp_seconds(arr + (q * 2 - 10) * 60).alias("actual_arrival"),
    )


def maintenance_events(events: DataFrame) -> DataFrame:
    """Maintenance events with their cost parts (P04 source), from the error events."""
    eid = F.col("event_id")
    total = F.col("value").cast("decimal(10,2)")
    labor = F.floor("value").cast("decimal(10,2)")
    return events.filter(F.col("event_type") == "error").select(
        eid.alias("event_id"),
        _text("N", 1000 + F.col("user_id") % 10).alias("tail_number"),
        F.col("ts").cast("timestamp").alias("start_time"),
        F.timestamp_seconds(F.unix_timestamp(F.col("ts").cast("timestamp")) + (eid % 48) * 3600)
        .alias("end_time"),
        labor.alias("labor_cost"),
        (total - labor).cast("decimal(10,2)").alias("parts_cost"),
    )


def airport_code(key: F.Column) -> F.Column:
    """IATA code of the derived airport dimension for an airport key."""
    return F.concat(F.lit("A"), F.lpad(key.cast("string"), 2, "0"))


# Weather condition reported for each event type of the log (own mapping).
CONDITION_OF_EVENT = {"view": "Weather 1", "click": "Weather 2", "purchase": "Weather 3",
                      "signup": "Weather 4", "error": "Weather 5"}
# The document's standardisation of raw severities to Low/Medium/High.
SEVERITY_MAP = {"None": "Low", "Moderate": "Medium", "Severe": "High"}


def weather_observations(events: DataFrame) -> DataFrame:
    """Weather readings (P08 source): airport, time, condition, raw severity."""
    cond = F.lit("Weather 5")
    for event, name in reversed(list(CONDITION_OF_EVENT.items())):
        cond = F.when(F.col("event_type") == event, name).otherwise(cond)
    sev = (F.when(F.col("value") < 100, "None").when(F.col("value") < 300, "Moderate")
           .otherwise("Severe"))
    return events.select(airport_code(F.col("user_id") % 25).alias("airport_code"),
                         F.col("ts").cast("timestamp").alias("timestamp"),
                         cond.alias("condition"), sev.alias("severity"))


def flight_departures(lineitem: DataFrame) -> DataFrame:
    """Flights with their departure airport and scheduled departure time."""
    pk = F.col("l_partkey")
    day = F.unix_timestamp(F.date_add(F.to_date("l_shipdate"), SHIFT_DAYS).cast("timestamp"))
    return lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("FlightFactKey"),
        airport_code(pk % 25).alias("departure_airport"),
        F.timestamp_seconds(day + (pk % 24) * 3600).alias("departure_time"))
