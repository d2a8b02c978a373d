"""Referential integrity (P13): every foreign key counted, failing rows rejected with their reasons.

All foreign keys of all tables are checked together: each table is read once
and exploded to (foreign key, value), which is counted per distinct value
before any shuffle of size; the counts of all keys meet the dimension keys in
one anti join. What is left, the orphan values, is written once and drives
both the report and the rejection.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostar.functions.measures import rows
from aerostar.session import checkpoint_dir
from aerostar.sources.star import Warehouse

# Fixed values of the original: table -> (name, row key, {column: (dimension, its key)}).
_FLIGHT = ("flight", "FlightKey")
_DATE = ("date", "DateKey")
_AIRPORT = ("airport", "AirportKey")
_AIRCRAFT = ("aircraft", "AircraftKey")
_CARRIER = ("carrier", "CarrierKey")
FOREIGN_KEYS = {
    "fact_flight": ("FactFlight", "FlightFactKey", {
        "FlightKey": _FLIGHT, "DateKey": _DATE, "AircraftKey": _AIRCRAFT, "DepartureAirportKey": _AIRPORT,
        "ArrivalAirportKey": _AIRPORT, "CarrierKey": _CARRIER, "WeatherKey": ("weather", "WeatherKey")}),
    "fact_booking": ("FactBooking", "BookingKey", {
        "FlightKey": _FLIGHT, "DateKey": _DATE, "CustomerKey": ("customer", "CustomerKey"),
        "FareClassKey": ("fare_class", "FareClassKey")}),
    "fact_cargo": ("FactCargo", "CargoKey", {
        "FlightKey": _FLIGHT, "DateKey": _DATE, "DepartureAirportKey": _AIRPORT, "ArrivalAirportKey": _AIRPORT}),
    "fact_maintenance": ("FactMaintenance", "MaintenanceKey", {
        "AircraftKey": _AIRCRAFT, "DateKey": _DATE, "MaintenanceTypeKey": ("maintenance_type", "MaintenanceTypeKey")}),
    "flight": ("DimFlight", "FlightKey", {
        "CarrierKey": _CARRIER, "DepartureAirportKey": _AIRPORT, "ArrivalAirportKey": _AIRPORT}),
}
#: (table name, column) of every foreign key.
ALL_KEYS = [(name, column) for name, _, columns in FOREIGN_KEYS.values() for column in columns]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _values(wh: Warehouse, table: str) -> DataFrame:
    """TableName, ForeignKey, Value, n of the non-null keys of one table, from one scan."""
    name, _, columns = FOREIGN_KEYS[table]
    pairs = F.array(*[F.struct(F.lit(c).alias("ForeignKey"), F.col(c).cast("long").alias("Value")) for c in columns])
    return (getattr(wh, table).select(*columns).select(F.inline(pairs)).filter("Value IS NOT NULL")
            .groupBy("ForeignKey", "Value").agg(rows().alias("n")).withColumn("TableName", F.lit(name)))


def orphan_values(wh: Warehouse) -> DataFrame:
    """TableName, ForeignKey, Value, n: key values that no dimension row has, and how many rows carry them."""
    wanted = {target for _, _, columns in FOREIGN_KEYS.values() for target in columns.values()}
    known = _union([getattr(wh, dim).select(F.lit(f"{dim}.{key}").alias("Target"), F.col(key).cast("long").alias("Value"))
                    for dim, key in sorted(wanted)]).distinct()
    target = F.create_map(*[F.lit(x) for name, _, columns in FOREIGN_KEYS.values() for c, (dim, key) in columns.items()
                            for x in (f"{name}.{c}", f"{dim}.{key}")])
    counts = _union([_values(wh, t) for t in FOREIGN_KEYS]).withColumn(
        "Target", target[F.concat_ws(".", "TableName", "ForeignKey")])
    return counts.join(known, ["Target", "Value"], "left_anti").select("TableName", "ForeignKey", "Value", "n")


def dq_foreign_keys(wh: Warehouse) -> DataFrame:
    """CheckName, Failures, Passed for each of the foreign keys; an optional key may be null."""
    found = orphan_values(wh).groupBy("TableName", "ForeignKey").agg(F.sum("n").alias("n"))
    spark = wh.fact_flight.sparkSession
    # A row for each key, also those without orphans: as many as ALL_KEYS.
    names = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("TableName"), F.lit(c).alias("ForeignKey")) for t, c in ALL_KEYS])))
    failures = F.coalesce("n", F.lit(0)).cast("long")
    return names.join(found, ["TableName", "ForeignKey"], "left").select(
        F.concat_ws(".", "TableName", "ForeignKey").alias("CheckName"), failures.alias("Failures"), (failures == 0).alias("Passed"))


def with_missing_keys(wh: Warehouse, table: str, orphans: DataFrame) -> DataFrame:
    """The rows of ``table`` and MissingKeys, the names of their orphaned keys; null where none is.

    Each key meets only the orphan values of its own column: adaptive
    execution broadcasts such a list when it measures small, so the table is
    read once and not shuffled; a long list is a sort-merge join, skew split.
    """
    name, _, columns = FOREIGN_KEYS[table]
    df, flags = getattr(wh, table), []
    for c in columns:
        bad = orphans.filter((F.col("TableName") == name) & (F.col("ForeignKey") == c)).select(
            F.col("Value").alias(f"_v_{c}"))
        df = df.join(bad, F.col(c).cast("long") == F.col(f"_v_{c}"), "left")
        flags.append(F.when(F.col(f"_v_{c}").isNotNull(), F.lit(c)))
    missing = F.array_compact(F.array(*flags))
    return (df.withColumn("MissingKeys", F.when(F.size(missing) > 0, missing))
            .drop(*[f"_v_{c}" for c in columns]))


def stored_orphans(wh: Warehouse, out_dir: str | None = None) -> DataFrame:
    """The orphan values, written to the shared folder: they are read once for each key."""
    spark = wh.fact_flight.sparkSession
    path = f"{(out_dir or checkpoint_dir(spark)).rstrip('/')}/orphans/{uuid.uuid4().hex}"
    orphan_values(wh).write.parquet(path)
    return spark.read.parquet(path)


def quarantined(wh: Warehouse, out_dir: str | None = None) -> DataFrame:
    """TableName, RowKey, MissingKeys (comma-separated) of every row that is rejected for an orphaned key."""
    orphans = stored_orphans(wh, out_dir)
    return _union([with_missing_keys(wh, t, orphans).filter("MissingKeys IS NOT NULL").select(
        F.lit(name).alias("TableName"), F.col(key).cast("long").alias("RowKey"), F.concat_ws(",", "MissingKeys").alias("MissingKeys"))
        for t, (name, key, _) in FOREIGN_KEYS.items()])


def load_checked(wh: Warehouse, out_dir: str) -> Warehouse:
    """Write every checked table in one pass each, orphans apart: ``<out>/<table>/Rejected=0|1``.

    Returns the warehouse with the clean rows read back; the rejected ones
    stay in their folder with MissingKeys. A table is visible as a whole or
    not at all: a failed write leaves no ``_SUCCESS`` and raises.
    """
    spark, orphans, clean = wh.fact_flight.sparkSession, stored_orphans(wh, out_dir), {}
    for t in FOREIGN_KEYS:
        path = f"{out_dir.rstrip('/')}/{t}"
        checked = with_missing_keys(wh, t, orphans)
        checked.withColumn("Rejected", F.col("MissingKeys").isNotNull().cast("int")).write.partitionBy("Rejected").parquet(path)
        schema = checked.schema.add("Rejected", T.IntegerType())
        clean[t] = spark.read.schema(schema).parquet(path).filter("Rejected = 0").drop("Rejected", "MissingKeys")
    return wh.with_tables(**clean)
