"""The airline star schema: 9 dimensions and 4 facts.

``derive_star`` builds the warehouse from the driver's TPC-H-like tables
(the fixture derivation of FIXTURES.md).  ``write_star``/``load_star`` keep a
materialised copy as Parquet, facts partitioned by month of ``DateKey`` so
date filters prune directories and row groups.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerostar.functions.dates import date_dimension, date_key
from aerostar.sources.catalog import SOURCES, conform

# Every order/ship date is moved by this many days (1995-01-01 -> 2020-01-01)
# so the facts fall inside the date dimension.
SHIFT_DAYS = 9131

# Partition column of the materialised facts: YYYYMM of DateKey.
MONTH_PART = "DateMonth"

# Dimensions whose row count is fixed by construction (a generated calendar,
# inline reference rows, the 25 nations and 5 regions of the source); only
# these are broadcast by hint.  Every other dimension grows with the data and
# is left to adaptive execution, which broadcasts it only after measuring it.
BOUNDED_DIMS = ("date",)


@dataclass(frozen=True)
class Warehouse:
    date: DataFrame
    airport: DataFrame
    carrier: DataFrame
    aircraft: DataFrame
    customer: DataFrame
    fare_class: DataFrame
    flight: DataFrame
    weather: DataFrame
    maintenance_type: DataFrame
    fact_flight: DataFrame
    fact_booking: DataFrame
    fact_cargo: DataFrame
    fact_maintenance: DataFrame

    def with_tables(self, **tables: DataFrame) -> "Warehouse":
        return replace(self, **tables)

    def names(self) -> list[str]:
        return [f.name for f in fields(self)]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table, held to its declaration (``catalog.SOURCES``)."""
    return conform(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), name, SOURCES.get(name, {}))


def _shifted(ts: Column) -> Column:
    return F.date_add(F.to_date(ts), SHIFT_DAYS)


def _text(prefix: str, num: Column) -> Column:
    return F.concat(F.lit(prefix), num.cast("string"))


def flight_base(lineitem: DataFrame) -> DataFrame:
    """Every line item under a unique key: the shared source of flights and cargo.

    (order, line) repeats in the source; the first line in the order of all
    other columns keeps the plain key, the n-th is moved by (n - 1) * 2^40.
    """
    own = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus")
    return lineitem.withColumn("nth", F.row_number().over(own)).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")
         + (F.col("nth") - 1).cast("long") * F.lit(1 << 40)).alias("k"),
        F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"),
        F.floor("l_quantity").cast("int").alias("q"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_discount").alias("disc"), F.col("l_returnflag").alias("rf"),
        F.col("l_linestatus").alias("ls"),
        _shifted(F.col("l_shipdate")).alias("d"),
    )


def _airport_keys(pk: Column) -> list[Column]:
    """Departure and arrival airport of a schedule key."""
    return [
        (pk % 25).cast("int").alias("DepartureAirportKey"),
        ((pk + 1 + pk % 4) % 25).cast("int").alias("ArrivalAirportKey"),
    ]


# Fixed values: (modulus, remainder) of the fact keys whose stored row breaks a quality rule.
BAD_FLIGHTS = {
    "seats": (1009, 11), "departure_delay": (1013, 17), "arrival_delay": (1019, 19), "revenue": (1021, 23),
    "carrier": (997, 5), "arrival_airport": (991, 7), "weather": (983, 9), "aircraft": (977, 3), "times": (967, 13),
}
# A key that no dimension has.
UNKNOWN_KEY = 99


def bad_flight(rule: str) -> Column:
    modulus, rest = BAD_FLIGHTS[rule]
    return F.col("k") % modulus == rest


def fact_flight(base: DataFrame) -> DataFrame:
    """Flights, with a few rows that break a quality rule each (BAD_FLIGHTS).

    Cancelled flights have no actual times; late ones arrive after midnight.
    """
    pk, sk, q, k = F.col("pk"), F.col("sk"), F.col("q"), F.col("k")
    seats = (F.lit(150) + pk % 200).cast("int")
    filled = F.when(bad_flight("seats"), seats + 3).otherwise(seats - q).cast("int")
    late = F.when(bad_flight("departure_delay"), 1500).otherwise(q - 5).cast("int")
    later = F.when(bad_flight("arrival_delay"), -75).otherwise(q * 2 - 10).cast("int")
    departs = F.unix_timestamp(F.col("d").cast("timestamp")) + (pk % 24) * 3600
    left = departs + late * 60
    arrived = F.when(bad_flight("times"), left - 1200).otherwise(departs + (30 + pk % 300 + later) * 60)
    flown = ~(F.col("disc") >= 0.095)
    departure, arrival = _airport_keys(pk)
    load = F.round(F.lit(100).cast("decimal(3,0)") * filled / seats, 2).cast("decimal(5,2)")
    return base.select(
        k.alias("FlightFactKey"),
        pk.alias("FlightKey"),
        date_key(F.col("d")).alias("DateKey"),
        F.when(bad_flight("aircraft"), -1 - sk).otherwise(sk).alias("AircraftKey"),
        departure,
        F.when(bad_flight("arrival_airport"), UNKNOWN_KEY).otherwise(arrival).cast("int").alias("ArrivalAirportKey"),
        F.when(bad_flight("carrier"), UNKNOWN_KEY).otherwise(sk % 5).cast("int").alias("CarrierKey"),
        F.when(bad_flight("weather"), UNKNOWN_KEY).when(k % 8 == 7, F.lit(None)).otherwise(1 + k % 5)
        .cast("int").alias("WeatherKey"),
        F.when(flown, F.timestamp_seconds(left)).cast("timestamp_ntz").alias("ActualDepartureTime"),
        F.when(flown, F.timestamp_seconds(arrived)).cast("timestamp_ntz").alias("ActualArrivalTime"),
        late.alias("DepartureDelayMin"),
        later.alias("ArrivalDelayMin"),
        (F.lit(30) + pk % 300).cast("int").alias("AirTimeMin"),
        seats.alias("SeatsAvailable"),
        filled.alias("SeatsFilled"),
        load.alias("LoadFactor"),
        F.when(bad_flight("revenue"), -F.col("price")).otherwise(F.col("price")).cast("decimal(12,2)").alias("Revenue"),
        (q * 500).cast("decimal(10,2)").alias("FuelCost"),
        (q * 200).cast("decimal(10,2)").alias("CrewCost"),
        (F.lit(1000) + pk % 500).cast("decimal(10,2)").alias("AirportFees"),
        (F.col("disc") >= 0.095).alias("CancellationFlag"),
        (F.col("rf") == "R").alias("WeatherImpactFlag"),
        ((F.col("rf") == "A") & (F.col("ls") == "O")).alias("MechanicalDelayFlag"),
        (F.lit(200) + pk % 2800).cast("int").alias("DistanceMiles"),
    )


def fact_cargo(base: DataFrame) -> DataFrame:
    pk, q = F.col("pk"), F.col("q")
    return base.filter(F.col("rf") == "R").select(
        F.col("k").alias("CargoKey"),
        pk.alias("FlightKey"),
        date_key(F.col("d")).alias("DateKey"),
        *_airport_keys(pk),
        F.when(q == 1, F.lit(0)).otherwise(q * 10).cast("decimal(10,2)").alias("WeightKg"),
        (q * 25 + pk % 7).cast("decimal(10,2)").alias("Revenue"),
        (F.col("ls") == "F").alias("OnTimeDeliveryFlag"),
    )


def fact_booking(orders: DataFrame) -> DataFrame:
    ok = F.col("o_orderkey")
    d = _shifted(F.col("o_orderdate"))
    price = F.col("o_totalprice").cast("decimal(10,2)")
    cancelled = (F.col("o_orderstatus") == "P") & (ok % 3 == 0)
    # Customers 1, 51, 101... have no bookings: theirs go to the customer before.
    customer = F.col("o_custkey") - F.when(F.col("o_custkey") % 50 == 1, 1).otherwise(0)
    return orders.select(
        ok.alias("BookingKey"),
        (ok % 200).cast("int").alias("FlightKey"),
        date_key(d).alias("DateKey"),
        customer.alias("CustomerKey"),
        (1 + ok % 5).cast("int").alias("FareClassKey"),
        F.date_add(d, (-(ok % 60)).cast("int")).alias("BookingDate"),
        d.alias("TravelDate"),
        price.alias("TicketPrice"),
        F.lit(10).cast("decimal(8,2)").alias("Taxes"),
        F.lit(5).cast("decimal(8,2)").alias("Fees"),
        (price + 15).cast("decimal(10,2)").alias("TotalAmount"),
        F.when(cancelled, "CANCELLED").otherwise("CONFIRMED").alias("BookingStatus"),
        cancelled.alias("CancellationFlag"),
        (ok % 500).cast("int").alias("LoyaltyPointsEarned"),
        (ok % 100).cast("int").alias("LoyaltyPointsRedeemed"),
    )


def fact_maintenance(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    mdate = F.date_add(F.to_date("ts"), ((eid % 12) * 30).cast("int"))
    return events.filter(F.col("event_type") == "error").select(
        eid.alias("MaintenanceKey"),
        (F.col("user_id") % 10).cast("int").alias("AircraftKey"),
        date_key(mdate).alias("DateKey"),
        (1 + eid % 4).cast("int").alias("MaintenanceTypeKey"),
        mdate.alias("MaintenanceDate"),
        F.col("value").cast("decimal(10,2)").alias("TotalCost"),
        (eid % 48).cast("decimal(6,2)").alias("DowntimeHours"),
        (eid % 6).cast("int").alias("FlightsAffected"),
    )


def dim_flight(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    # Every 97th schedule row carries a key that no fact has: its facts are orphans.
    # Every 89th arrives at an airport that isn't known.
    departure, arrival = _airport_keys(pk)
    return part.select(
        F.when(pk % 97 == 0, -1 - pk).otherwise(pk).alias("FlightKey"),
        _text("FL", 1000 + pk).alias("FlightNumber"),
        (pk % 5).cast("int").alias("CarrierKey"),
        departure,
        F.when(pk % 89 == 4, UNKNOWN_KEY).otherwise(arrival).cast("int").alias("ArrivalAirportKey"),
    )


_VALIDITY_START = dt.date(2020, 1, 1)
# Rows that are not current were closed on this day (a valid SCD2 history).
_VALIDITY_CLOSED = dt.date(2023, 12, 31)


def _expiration(is_current: Column) -> Column:
    return F.when(is_current, F.lit(None).cast("date")).otherwise(F.lit(_VALIDITY_CLOSED))


def dim_airport(nation: DataFrame, region: DataFrame) -> DataFrame:
    nk = F.col("n_nationkey")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        nk.alias("AirportKey"),
        F.concat(F.lit("A"), F.lpad(nk.cast("string"), 2, "0")).alias("IATA"),
        F.concat(F.lit("KA"), F.lpad(nk.cast("string"), 2, "0")).alias("ICAO"),
        F.col("n_name").alias("AirportName"),
        _text("CITY_", nk % 20).alias("City"),
        F.col("n_name").alias("Country"),
        F.col("r_name").alias("Region"),
        (nk * 3 - 40).cast("decimal(9,6)").alias("Latitude"),
        (nk * 7 - 90).cast("decimal(9,6)").alias("Longitude"),
        F.lit(_VALIDITY_START).alias("EffectiveDate"),
        F.lit(None).cast("date").alias("ExpirationDate"),
        (nk != 24).alias("IsCurrent"),
    )


def dim_carrier(region: DataFrame) -> DataFrame:
    rk = F.col("r_regionkey")
    return region.select(
        rk.alias("CarrierKey"),
        _text("C", rk).alias("AirlineCode"),
        F.col("r_name").alias("CarrierName"),
        F.when(rk == 4, F.lit(None)).when(rk == 3, "Alpha").otherwise("Beta").alias("AllianceCode"),
        F.col("r_name").alias("Country"),
        F.lit(_VALIDITY_START).alias("EffectiveDate"),
        F.lit(None).cast("date").alias("ExpirationDate"),
        F.lit(True).alias("IsCurrent"),
    )


def dim_aircraft(supplier: DataFrame) -> DataFrame:
    sk = F.col("s_suppkey")
    age = (1 + sk % 14).cast("int")
    return supplier.select(
        sk.alias("AircraftKey"),
        _text("N", 1000 + sk).alias("TailNumber"),
        F.when(sk % 3 == 0, "Widebody").otherwise("Narrowbody").alias("AircraftType"),
        F.when(sk % 2 == 0, "Boeing").otherwise("Airbus").alias("Manufacturer"),
        _text("M", sk % 4).alias("Model"),
        (150 + sk % 200).cast("int").alias("SeatingCapacity"),
        (2024 - age).cast("int").alias("ManufactureYear"),
        age.alias("Age"),
        F.when(sk % 2 == 0, "Owned").otherwise("Leased").alias("OwnershipType"),
        F.lit(_VALIDITY_START).alias("EffectiveDate"),
        F.lit(None).cast("date").alias("ExpirationDate"),
        (sk % 10 != 9).alias("IsCurrent"),
    )


def dim_customer(customer: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    tier = (F.when(seg == "MACHINERY", "Silver").when(seg == "AUTOMOBILE", "Gold")
            .when(seg == "FURNITURE", "Platinum").otherwise("Bronze"))
    return customer.select(
        ck.alias("CustomerKey"),
        _text("CUST", 10000 + ck).alias("CustomerID"),
        _text("F", ck % 50).alias("FirstName"),
        F.col("c_name").alias("LastName"),
        F.concat(F.col("c_name"), F.lit("@x.org")).alias("Email"),
        _text("+1-555-", 1000 + ck % 9000).alias("Phone"),
        tier.alias("LoyaltyTier"),
        F.floor(F.abs(F.col("c_acctbal"))).cast("int").alias("LoyaltyPoints"),
        F.lit(_VALIDITY_START).alias("JoinDate"),
        F.date_add(F.lit(dt.date(1945, 1, 1)), ((ck * 37) % 20000).cast("int")).alias("BirthDate"),
        F.when(ck % 2 == 0, "F").otherwise("M").alias("Gender"),
        _text("NATION_", F.col("c_nationkey")).alias("Country"),
        _text("CITY_", F.col("c_nationkey") % 20).alias("City"),
        F.lit(_VALIDITY_START).alias("EffectiveDate"),
        _expiration(ck % 20 != 0).alias("ExpirationDate"),
        (ck % 20 != 0).alias("IsCurrent"),
    )


# The three reference dimensions are derived from the regions, one row each.
def dim_fare_class(region: DataFrame) -> DataFrame:
    rk = F.col("r_regionkey")
    return region.select(
        (1 + rk).cast("int").alias("FareClassKey"),
        _text("R", rk).alias("FareCode"),
        F.concat(F.lit("Fare "), F.col("r_name")).alias("ClassName"),
        _text("Cabin ", rk % 3).alias("CabinClass"),
        _text("Band ", rk % 2).alias("PriceBand"),
        (rk % 2 == 0).alias("RefundableFlag"),
        (rk % 2 == 1).alias("ChangeFeeFlag"),
        (rk % 4).cast("int").alias("BaggageAllowance"),
        (rk >= 3).alias("PriorityBoarding"),
    )


def dim_weather(region: DataFrame) -> DataFrame:
    rk = F.col("r_regionkey")
    severity = F.when(rk % 3 == 0, "Low").when(rk % 3 == 1, "Medium").otherwise("High")
    return region.select(
        (1 + rk).cast("int").alias("WeatherKey"),
        _text("Weather ", 1 + rk).alias("WeatherCondition"),
        severity.alias("Severity"),
        severity.alias("ImpactLevel"),
        F.concat(F.lit("As seen in "), F.col("r_name")).alias("Description"),
    )


def dim_maintenance_type(region: DataFrame) -> DataFrame:
    rk = F.col("r_regionkey")
    return region.filter(rk < 4).select(
        (1 + rk).cast("int").alias("MaintenanceTypeKey"),
        _text("MT", rk).alias("MaintenanceCode"),
        _text("Category ", rk % 2).alias("MaintenanceCategory"),
        F.col("r_name").alias("Description"),
        (rk != 3).alias("IsScheduled"),
        (6 * (1 + rk)).cast("decimal(5,2)").alias("AverageDurationHours"),
    )


def derive_star(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> Warehouse:
    """Build the warehouse lazily from the driver's tables.

    ``base`` may be a stored copy of ``flight_base`` (see ``build_star``).
    """
    read = lambda name: read_table(spark, sf_dir, name)
    if base is None:
        base = flight_base(read("lineitem"))
    return Warehouse(
        date=date_dimension(spark),
        airport=dim_airport(read("nation"), read("region")),
        carrier=dim_carrier(read("region")),
        aircraft=dim_aircraft(read("supplier")),
        customer=dim_customer(read("customer")),
        fare_class=dim_fare_class(read("region")),
        flight=dim_flight(read("part")),
        weather=dim_weather(read("region")),
        maintenance_type=dim_maintenance_type(read("region")),
        fact_flight=fact_flight(base),
        fact_booking=fact_booking(read("orders")),
        fact_cargo=fact_cargo(base),
        fact_maintenance=fact_maintenance(read("events")),
    )


FACTS = ("fact_flight", "fact_booking", "fact_cargo", "fact_maintenance")


def write_star(wh: Warehouse, out_dir: str, partitions: int | None = None) -> None:
    """Materialise the warehouse as Parquet.

    Facts are partitioned by ``DateMonth`` (YYYYMM) and sorted by DateKey
    inside each file, so date windows prune directories and row groups.
    Rows are range-partitioned on (DateKey, fact key) first: a month -- or a
    single day holding a large share of the rows -- is spread over many
    tasks instead of landing in one, and each task writes few directories.
    """
    spark = wh.fact_flight.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in wh.names():
        df = getattr(wh, name)
        path = f"{out_dir.rstrip('/')}/{name}"
        if name in FACTS:
            key = df.columns[0]
            (df.withColumn(MONTH_PART, (F.col("DateKey") / 100).cast("int"))
               .repartitionByRange(n, "DateKey", key)
               .sortWithinPartitions("DateKey", key)
               .write.mode("overwrite").partitionBy(MONTH_PART).parquet(path))
        else:
            df.write.mode("overwrite").parquet(path)


def build_star(spark: SparkSession, sf_dir: str, out_dir: str,
               partitions: int | None = None) -> Warehouse:
    """Derive and materialise the warehouse; returns it read back from Parquet.

    The per-line base shared by FactFlight and FactCargo (the one aggregation
    over the largest source) is written once to ``_stage/flight_base`` and
    both facts are derived from that written table, instead of aggregating
    the source twice.
    """
    write_star(stage_star(spark, sf_dir, out_dir), out_dir, partitions)
    return load_star(spark, out_dir)


def stage_star(spark: SparkSession, sf_dir: str, out_dir: str) -> Warehouse:
    """The lazy warehouse over a written ``flight_base``, for jobs that read the facts several times."""
    stage = f"{out_dir.rstrip('/')}/_stage/flight_base"
    flight_base(read_table(spark, sf_dir, "lineitem")).write.mode("overwrite").parquet(stage)
    return derive_star(spark, sf_dir, base=spark.read.parquet(stage))


def load_star(spark: SparkSession, star_dir: str) -> Warehouse:
    tables = {}
    for f in fields(Warehouse):
        tables[f.name] = spark.read.parquet(f"{star_dir.rstrip('/')}/{f.name}")
    return Warehouse(**tables)


def restrict_dates(fact: DataFrame, lo_key: int | None = None,
                   hi_key: int | None = None) -> DataFrame:
    """Keep fact rows with ``lo_key <= DateKey <= hi_key``.

    DateKey is order preserving, so a calendar window becomes a key range
    that reaches the Parquet scan; on a materialised fact the month
    partition column is restricted as well, which prunes directories.
    """
    cond = F.lit(True)
    if lo_key is not None:
        cond = cond & (F.col("DateKey") >= lo_key)
    if hi_key is not None:
        cond = cond & (F.col("DateKey") <= hi_key)
    if MONTH_PART in fact.columns:
        if lo_key is not None:
            cond = cond & (F.col(MONTH_PART) >= lo_key // 100)
        if hi_key is not None:
            cond = cond & (F.col(MONTH_PART) <= hi_key // 100)
    return fact.filter(cond)
