from pyspark.sql import functions as F

from aerostar import registry
from aerostar.functions.measures import exact_round, pct


def test_exact_round_ties_signs_and_zero(spark):
    df = spark.createDataFrame([(9116500, 100000), (-2345, 1000), (1, 0), (None, 3), (2, 3), (-1, 8)],
                               "n long, d long")
    got = [r[0] for r in df.select(exact_round(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [91.17, -2.35, None, None, 0.67, -0.13]
    got = [r[0] for r in df.select(pct(F.col("n"), F.col("d"), 2)).collect()]
    assert got[4] == 66.67 and got[2] is None


def test_every_job_runs_on_an_empty_warehouse(spark, wh):
    empty = wh.with_tables(**{name: getattr(wh, name).limit(0) for name in
                              ("fact_flight", "fact_booking", "fact_cargo", "fact_maintenance")})
    registry._load_all()
    one_row = {"kpi_overview": 1, "dq_report": 3, "executive_kpis": 1, "delay_causes": 2,
               "dq_orphaned_flights": 1, "dq_invalid_load_factors": 1, "dq_future_dates": 1}
    for name, fn in registry.JOBS.items():
        rows = fn(empty).collect()
        if name in one_row:
            assert len(rows) == one_row[name], name
    kpi = registry.JOBS["kpi_overview"](empty).first()
    assert kpi.TotalFlights == 0 and kpi.AvgLoadFactor is None and kpi.OnTimePercentage is None
