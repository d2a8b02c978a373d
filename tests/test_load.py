"""E08 as a stored load: written once, checked once, published or withheld."""
import pytest
from pyspark.sql import functions as F

from aerostar.plans.etl_jobs import load_flights, loads, read_load
from aerostar.sources.batches import flight_batch
from aerostar.sources.star import read_table

from conftest import SMALL


def test_publish_and_withhold(spark, wh, scratch):
    table, batch = f"{scratch}/facts", flight_batch(read_table(spark, SMALL, "lineitem"))
    schema = wh.fact_flight.schema
    with pytest.raises(ValueError):
        read_load(spark, table, schema)
    first = load_flights(wh, batch, table)
    assert (first["version"], first["status"]) == (1, "published") and first["checks"]["orphaned_flights"] > 0
    held = read_load(spark, table, schema)
    n = held.count()
    assert n == first["rows_loaded"]
    # No row may be an orphan: the second load is listed, but never read.
    second = load_flights(wh, batch.filter(F.col("FlightKey") < 0), table, allowed={"orphaned_flights": 0.0})
    assert (second["status"], second["failed_checks"]) == ("withheld", "orphaned_flights")
    assert read_load(spark, table, schema).inputFiles() == held.inputFiles()
    with pytest.raises(ValueError):
        read_load(spark, table, schema, version=2)
    third = load_flights(wh, batch.filter(F.col("FlightKey") < 0), table, allowed={"orphaned_flights": 1.0})
    assert (third["version"], third["status"]) == (3, "published")
    assert held.count() == n  # a reader keeps the load that it opened
    assert [r.status for r in loads(spark, table).orderBy("version").collect()] == ["published", "withheld", "published"]


def test_the_report_reads_the_facts_once(spark, wh, scratch):
    from aerostar.operators.quality import dq_report
    wh.fact_flight.write.parquet(f"{scratch}/f")
    stored = wh.with_tables(fact_flight=spark.read.parquet(f"{scratch}/f"))
    scans = dq_report(stored)._jdf.queryExecution().executedPlan().toString().count(f"{scratch}/f")
    assert scans == 1
    # A row without a flight is an orphan.
    empty = stored.fact_flight.limit(3).withColumn("FlightKey", F.lit(None).cast("long"))
    got = {r.CheckName: r.Failures for r in dq_report(stored.with_tables(fact_flight=empty)).collect()}
    assert got["orphaned_flights"] == 3
