import datetime as dt

from pyspark.sql import functions as F

from aerostar.functions.dates import age_in_years, date_dimension


def test_date_dimension_goldens(spark):
    d = date_dimension(spark)
    row = d.agg(F.count("*").alias("n"), F.sum(F.col("IsWeekend").cast("int")).alias("we"),
                F.sum(F.col("HolidayFlag").cast("int")).alias("hol"),
                F.min("Date").alias("lo"), F.max("Date").alias("hi")).first()
    assert (row.n, row.we, row.hol) == (4018, 1148, 44)
    assert row.lo == dt.date(2020, 1, 1) and row.hi == dt.date(2030, 12, 31)


def test_fiscal_quarters_and_keys(spark):
    d = {r.Date: r for r in date_dimension(spark, dt.date(2023, 9, 30), dt.date(2024, 1, 1)).collect()}
    assert d[dt.date(2023, 9, 30)].FiscalQuarter == 4 and d[dt.date(2023, 9, 30)].FiscalYear == 2023
    assert d[dt.date(2023, 10, 1)].FiscalQuarter == 1 and d[dt.date(2023, 10, 1)].FiscalYear == 2024
    assert d[dt.date(2024, 1, 1)].FiscalQuarter == 2 and d[dt.date(2024, 1, 1)].DateKey == 20240101
    assert d[dt.date(2023, 12, 30)].IsWeekend and not d[dt.date(2023, 12, 29)].IsWeekend
    assert d[dt.date(2023, 10, 1)].DayOfWeek == "Sunday"


def test_padded_names(spark):
    r = date_dimension(spark, dt.date(2024, 5, 1), dt.date(2024, 5, 1), pad_names=True).first()
    assert r.MonthName == "May      " and r.DayOfWeek == "Wednesday"


def test_age_on_leap_day(spark):
    df = spark.createDataFrame([(dt.date(2000, 2, 29),), (dt.date(2000, 3, 1),)], "b date")
    got = [r[0] for r in df.select(age_in_years(dt.date(2001, 2, 28), F.col("b"))).collect()]
    assert got == [0, 0]
    got = [r[0] for r in df.select(age_in_years(dt.date(2001, 3, 1), F.col("b"))).collect()]
    assert got == [1, 1]
