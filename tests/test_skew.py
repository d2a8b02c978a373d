"""Every report job on a heavily skewed star against the oracle SQL.

One aircraft holds a third of the flights and half of the maintenance, one
schedule key a third of the flights and half of the bookings, one customer a
third of the bookings, one day a fifth of the flights.  The oracle bodies run
in DuckDB over the same skewed tables (the fan-out joins are executed
literally there), so the per-key rewrites must stay exact under skew.
"""
import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from aerostar import registry
from aerostar.oracle.prelude import PRELUDE
from aerostar.oracle.etl_texts import ETL_TEXTS
from aerostar.oracle.texts import TEXTS
from aerostar.sources.star import load_star, write_star
from tools.compare import compare

STAR_TABLES = {"fact_flight": "FactFlight", "fact_booking": "FactBooking", "fact_cargo": "FactCargo",
               "fact_maintenance": "FactMaintenance", "flight": "DimFlight", "airport": "DimAirport",
               "carrier": "DimCarrier", "aircraft": "DimAircraft", "customer": "DimCustomer",
               "date": "DimDate", "fare_class": "DimFareClass", "weather": "DimWeather",
               "maintenance_type": "DimMaintenanceType"}


def _body(text: str) -> str:
    """The oracle text without the star derivation (its CTEs would shadow the views)."""
    head = "WITH " + PRELUDE.rstrip()
    assert text.startswith(head)
    rest = text[len(head):]
    return "WITH " + rest.lstrip()[1:] if rest.lstrip().startswith(",") else rest


@pytest.fixture(scope="module")
def skewed(spark, wh):
    ff, fb, fm = wh.fact_flight, wh.fact_booking, wh.fact_maintenance
    ff = (ff.withColumn("AircraftKey", F.when(F.col("FlightFactKey") % 3 == 0, F.lit(0).cast("long"))
                        .otherwise(F.col("AircraftKey")))
            .withColumn("FlightKey", F.when(F.col("FlightFactKey") % 3 == 1, F.lit(5).cast("long"))
                        .otherwise(F.col("FlightKey")))
            .withColumn("DateKey", F.when(F.col("FlightFactKey") % 5 == 0, F.lit(20241215))
                        .otherwise(F.col("DateKey"))))
    fb = (fb.withColumn("CustomerKey", F.when(F.col("BookingKey") % 3 == 0, F.lit(3).cast("long"))
                        .otherwise(F.col("CustomerKey")))
            .withColumn("FlightKey", F.when(F.col("BookingKey") % 2 == 0, F.lit(5))
                        .otherwise(F.col("FlightKey"))))
    fm = fm.withColumn("AircraftKey", F.when(F.col("MaintenanceKey") % 2 == 0, F.lit(0))
                       .otherwise(F.col("AircraftKey")))
    path = tempfile.mkdtemp(prefix="aerostar-skew-")
    write_star(wh.with_tables(fact_flight=ff, fact_booking=fb, fact_maintenance=fm), path)
    con = duckdb.connect()
    for attr, view in STAR_TABLES.items():
        files = os.path.join(path, attr, "**", "*.parquet")
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{files}', "
                    f"hive_partitioning = true)")
    return load_star(spark, path), con


registry._load_all()
ALL_TEXTS = {**TEXTS, **ETL_TEXTS}
WAREHOUSE_JOBS = sorted(n for n in registry.JOBS if n in ALL_TEXTS)


def test_every_warehouse_job_is_covered():
    assert set(WAREHOUSE_JOBS) == set(registry.JOBS)


@pytest.mark.parametrize("name", WAREHOUSE_JOBS)
def test_report_jobs_exact_under_skew(skewed, name):
    stored, con = skewed
    ok, msg = compare(registry.JOBS[name](stored), con, _body(ALL_TEXTS[name]))
    assert ok, msg
