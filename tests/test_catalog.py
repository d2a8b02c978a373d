"""Sources are held to their declaration when opened; single records are rejected or filled by rule."""
import os

import pytest
from pyspark.sql import functions as F

from aerostar.sources.catalog import FLIGHT_RECORD, SOURCES, Rule, conform, read_csv, rule_counts, split_rows
from aerostar.sources.star import derive_star, read_table

from conftest import SMALL


def test_declared_sources_keep_their_plan(spark):
    for name in SOURCES:
        plain = spark.read.parquet(f"{SMALL}/{name}.parquet")
        assert conform(plain, name, SOURCES[name]) is plain
        assert read_table(spark, SMALL, name).schema == plain.schema


def test_wrong_schema_fails_when_opened(spark, scratch):
    for name in SOURCES:
        df = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "lineitem":
            df = df.drop("l_shipdate").withColumn("l_quantity", F.col("l_quantity").cast("string"))
        df.limit(5).write.parquet(f"{scratch}/{name}.parquet")
    with pytest.raises(ValueError, match="lineitem: l_quantity is string instead of double; l_shipdate is missing"):
        derive_star(spark, scratch)


def test_narrow_types_and_optional_columns(spark):
    df = spark.createDataFrame([(1, "x")], "event_id int, more string").withColumns({
        "ts": F.lit("2024-01-01").cast("date"), "user_id": F.lit(2), "event_type": F.lit("view"), "value": F.lit(1.5).cast("float")})
    out = conform(df, "events", SOURCES["events"])
    assert {f.name: f.dataType.simpleString() for f in out.schema} == {c: r.type for c, r in SOURCES["events"].items()} | {"more": "string"}
    row = out.first()
    assert (row.event_id, row.value, row.props, row.more) == (1, 1.5, None, "x")


def test_rejects_and_defaults(spark):
    rows = [(1, 20240101, 1, 1, 2, None, 3, None), (None, 20240101, None, 1, 2, 4, 5, True), (None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "FlightKey long, DateKey int, AircraftKey long, DepartureAirportKey int, ArrivalAirportKey int, "
                                     "DepartureDelayMin int, ArrivalDelayMin int, CancellationFlag boolean")
    good, bad = split_rows(df, FLIGHT_RECORD)
    assert [(r.FlightKey, r.DepartureDelayMin, r.CancellationFlag) for r in good.collect()] == [(1, 0, False)]
    assert sorted(len(r.RejectReasons) for r in bad.collect()) == [2, 5]
    counts = {r.ColumnName: (r.Rule, r.Nulls) for r in rule_counts(df, "t", FLIGHT_RECORD).collect()}
    assert counts["FlightKey"] == ("required", 2) and counts["DepartureDelayMin"] == ("default", 2) and "WeatherKey" not in counts
    assert [r.Nulls for r in rule_counts(df.limit(0), "t", FLIGHT_RECORD).collect()] == [0] * 8


def test_csv_lines(spark, scratch):
    rules = {"id": Rule("int", required=True), "name": Rule("string"), "delay": Rule("int", default=0)}
    path = os.path.join(scratch, "in.csv")
    with open(path, "w") as fh:
        fh.write("id,name,delay\n1,a,5\n2,b,\n,c,7\nx,d,1\n5,e,1,9\n6,f\n")
    good, bad = read_csv(spark, path, rules)
    assert sorted(tuple(r) for r in good.collect()) == [(1, "a", 5), (2, "b", 0)]
    got = {r.BadLine or "-": r.RejectReasons for r in bad.collect()}
    assert got == {"-": ["missing_id"], "x,d,1": ["malformed", "missing_id"], "5,e,1,9": ["malformed"], "6,f": ["malformed"]}
    assert good.select("name").count() == 2  # judged alike whatever is selected
    with open(path, "w") as fh:
        fh.write("id,delay,name\n1,5,a\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, path, rules)[0].collect()
