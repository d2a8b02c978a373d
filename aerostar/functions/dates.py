"""Date helpers: smart date keys, the date dimension, as-of windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the warehouse's date dimension (must match the original
# warehouse): its span, and the fixed month-day holidays in the order the
# original lists them.
DATE_DIM_START = dt.date(2020, 1, 1)
DATE_DIM_END = dt.date(2030, 12, 31)
HOLIDAYS_MM_DD = ("01-01", "07-04", "12-25", "11-28")

# Default report date and year used by the jobs and the oracle texts.
DEFAULT_AS_OF = dt.date(2024, 12, 31)
DEFAULT_YEAR = 2024


def date_key(d: Column) -> Column:
    """``YYYYMMDD`` integer key of a DATE column (order preserving)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_of(day: dt.date) -> int:
    """Python-side ``YYYYMMDD`` key of a constant date."""
    return day.year * 10000 + day.month * 100 + day.day


def days_before(as_of: dt.date, days: int) -> dt.date:
    return as_of - dt.timedelta(days=days)


def date_dimension(spark: SparkSession, start: dt.date = DATE_DIM_START,
                   end: dt.date = DATE_DIM_END, pad_names: bool = False) -> DataFrame:
    """One row per day in ``[start, end]`` with the 12 calendar attributes.

    Generated from ``spark.range`` so the rows are spread over partitions;
    a recursive CTE is neither needed nor possible beyond 100 levels.
    ``pad_names`` blank-pads day and month names to 9 characters, as the
    original ``TO_CHAR`` output did.
    """
    n_days = (end - start).days + 1
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    base = spark.range(0, n_days).select(day.alias("Date"))
    month = F.month("Date")
    dow_name = F.date_format("Date", "EEEE")
    month_name = F.date_format("Date", "MMMM")
    if pad_names:
        dow_name = F.rpad(dow_name, 9, " ")
        month_name = F.rpad(month_name, 9, " ")
    return base.select(
        date_key(F.col("Date")).alias("DateKey"),
        F.col("Date"),
        dow_name.alias("DayOfWeek"),
        F.dayofmonth("Date").alias("DayOfMonth"),
        month.alias("Month"),
        month_name.alias("MonthName"),
        F.quarter("Date").alias("Quarter"),
        F.year("Date").alias("Year"),
        F.date_format("Date", "MM-dd").isin(*HOLIDAYS_MM_DD).alias("HolidayFlag"),
        # Spark numbers days 1 = Sunday .. 7 = Saturday.
        F.dayofweek("Date").isin(1, 7).alias("IsWeekend"),
        F.when(month >= 10, F.year("Date") + 1).otherwise(F.year("Date")).alias("FiscalYear"),
        F.when(month >= 10, 1).when(month <= 3, 2).when(month <= 6, 3).otherwise(4)
        .alias("FiscalQuarter"),
    )


def age_in_years(as_of: dt.date, birth: Column) -> Column:
    """Whole calendar years between ``birth`` and ``as_of`` (exact on leap days)."""
    before_birthday = (F.month(birth) > as_of.month) | (
        (F.month(birth) == as_of.month) & (F.dayofmonth(birth) > as_of.day))
    return (F.lit(as_of.year) - F.year(birth) - F.when(before_birthday, 1).otherwise(0)).cast("int")
