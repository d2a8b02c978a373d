"""Flight ETL steps: transform (E01), validate (E02) and the documented
derivations P01-P05, P07, P08, P12.

Batches are DataFrames, never driver-side lists; every rule is a Column
expression, and rejected rows are kept with a reason instead of failing the job.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from aerostar.functions.measures import ON_TIME_MINUTES
from aerostar.sources.catalog import FLIGHT_RECORD, fill_defaults

#: The keys a flight record must carry.
REQUIRED_FLIGHT_KEYS = tuple(c for c, rule in FLIGHT_RECORD.items() if rule.required)


def load_factor(filled: Column, available: Column) -> Column:
    """``filled / available * 100`` rounded to 2 decimals (NULL for 0 / NULL seats)."""
    pct = F.try_divide(F.lit(100).cast("decimal(3,0)") * filled, available)
    return F.round(pct, 2).try_cast("decimal(5,2)")


def reject_reason(batch: DataFrame) -> Column:
    """E02 (+ zero seats): the first failing rule, NULL when the row is valid.

    Required keys must be present; SeatsAvailable < SeatsFilled fails (a
    missing seat count counts as 0, equal is valid).  Zero / missing seats
    make LoadFactor undefined and are rejected too.
    """
    reason = F.lit(None).cast("string")
    checks = [(F.col(k).isNull(), f"missing_{k}") for k in REQUIRED_FLIGHT_KEYS if k in batch.columns]
    checks += [(F.lit(True), f"missing_{k}") for k in REQUIRED_FLIGHT_KEYS
               if k not in batch.columns]
    avail = F.coalesce(F.col("SeatsAvailable"), F.lit(0))
    filled = F.coalesce(F.col("SeatsFilled"), F.lit(0))
    checks.append((avail < filled, "seats_filled_exceed_available"))
    checks.append((avail == 0, "no_seats_available"))
    for cond, label in reversed(checks):
        reason = F.when(cond, F.lit(label)).otherwise(reason)
    return reason


def validate_flights(batch: DataFrame) -> DataFrame:
    """The batch with a ``RejectReason`` column."""
    return batch.withColumn("RejectReason", reject_reason(batch))


def transform_flights(batch: DataFrame, late: int = ON_TIME_MINUTES) -> tuple[DataFrame, DataFrame]:
    """Documented defaults (P12), LoadFactor and OnTimeFlag; split into (valid, rejected)."""
    enriched = validate_flights(apply_defaults(batch).withColumns({
        "LoadFactor": load_factor(F.col("SeatsFilled"), F.col("SeatsAvailable")),
        "OnTimeFlag": F.col("ArrivalDelayMin") <= late,
    }))
    valid = enriched.filter(F.col("RejectReason").isNull()).drop("RejectReason")
    rejected = enriched.filter(F.col("RejectReason").isNotNull())
    return valid, rejected


def apply_defaults(batch: DataFrame) -> DataFrame:
    """Documented defaults (delays 0, cancellation FALSE); WeatherKey optional."""
    return fill_defaults(batch, FLIGHT_RECORD)


def derive_delays(src: DataFrame) -> DataFrame:
    """Delay minutes = actual - scheduled, for departure and arrival."""
    def minutes(actual: str, scheduled: str) -> Column:
        secs = F.unix_timestamp(F.col(actual).cast("timestamp")) - \
            F.unix_timestamp(F.col(scheduled).cast("timestamp"))
        return F.floor(secs / 60).cast("int")
    return src.withColumns({
        "DepartureDelayMin": minutes("actual_departure", "scheduled_departure"),
        "ArrivalDelayMin": minutes("actual_arrival", "scheduled_arrival"),
    })


def reject_load_factor_range(df: DataFrame, lo: int = 0, hi: int = 100) -> tuple[DataFrame, DataFrame]:
    """Rows whose LoadFactor lies outside ``[lo, hi]`` go to rejects."""
    bad = (F.col("LoadFactor") < lo) | (F.col("LoadFactor") > hi)
    return df.filter(~bad | F.col("LoadFactor").isNull()), df.filter(bad)


# Booking status values that mark a cancelled booking (documented rule).
CANCELLED_STATUSES = ("CANCELLED", "REFUNDED")


def derive_booking_totals(src: DataFrame) -> DataFrame:
    """TotalAmount = base fare + taxes + fees; cancelled by status."""
    return src.withColumns({
        "TotalAmount": (F.col("base_fare") + F.col("taxes") + F.col("fees")).cast("decimal(10,2)"),
        "CancellationFlag": F.col("booking_status").isin(*CANCELLED_STATUSES),
    })


def derive_maintenance(src: DataFrame) -> DataFrame:
    """DurationHours from start/end, TotalCost = labor + parts."""
    secs = F.unix_timestamp(F.col("end_time").cast("timestamp")) - \
        F.unix_timestamp(F.col("start_time").cast("timestamp"))
    return src.withColumns({
        "DurationHours": (secs / 3600.0).cast("decimal(6,2)"),
        "TotalCost": (F.col("labor_cost") + F.col("parts_cost")).cast("decimal(10,2)"),
    })


def with_key(df: DataFrame, dim: DataFrame, business_col: str, dim_business_col: str,
             key_col: str, out_col: str | None = None, current_only: bool = True) -> DataFrame:
    """P05 in one pass: every row with its surrogate key, or null and a RejectReason.

    The dimension side is reduced to (business key, surrogate key) of the
    current rows; adaptive execution broadcasts it only if it is small.
    """
    d = dim.filter(F.col("IsCurrent")) if current_only and "IsCurrent" in dim.columns else dim
    out = out_col or key_col
    d = d.select(F.col(dim_business_col).alias("__bk"), F.col(key_col).alias(out))
    j = df.join(d, df[business_col] == d["__bk"], "left").drop("__bk")
    return j.withColumn("RejectReason", F.when(F.col(out).isNull(), f"unknown_{business_col}"))


def lookup_keys(df: DataFrame, dim: DataFrame, business_col: str, dim_business_col: str,
                key_col: str, out_col: str | None = None,
                current_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """Business key -> surrogate key; (hits, rejects)."""
    j = with_key(df, dim, business_col, dim_business_col, key_col, out_col, current_only)
    return j.filter("RejectReason IS NULL").drop("RejectReason"), j.filter("RejectReason IS NOT NULL")


class Lookup(NamedTuple):
    """One business key to resolve: the source column, the dimension with its two key columns, the name of the result."""
    column: str
    dim: DataFrame
    business_key: str
    surrogate_key: str
    out: str


def resolve_keys(df: DataFrame, lookups: list[Lookup], current_only: bool = True) -> DataFrame:
    """P05 for all business keys of a record: every row once, with its surrogate keys and RejectReasons.

    RejectReasons names each key that is absent (``missing_<column>``) or that
    no dimension row has (``unknown_<column>``), in the order of ``lookups``;
    null where all are found. A dimension is reduced to one row per business
    key, the current version with the highest surrogate key, so no lookup can
    multiply rows. Lookups that share a dimension share its reduced form.
    """
    reasons, cols = [], [F.col(c) for c in df.columns]
    for n, lookup in enumerate(lookups):
        dim = lookup.dim
        if current_only and "IsCurrent" in dim.columns:
            dim = dim.filter(F.col("IsCurrent"))
        found, business = f"__key{n}", f"__bk{n}"
        one = dim.groupBy(F.col(lookup.business_key).alias(business)).agg(F.max(lookup.surrogate_key).alias(found))
        df = df.join(one, F.col(lookup.column) == F.col(business), "left")
        reasons.append(F.when(F.col(lookup.column).isNull(), f"missing_{lookup.column}")
                       .when(F.col(found).isNull(), f"unknown_{lookup.column}"))
        cols.append(F.col(found).alias(lookup.out))
    missed = F.array_compact(F.array(*reasons))
    return df.select(*cols, F.when(F.size(missed) > 0, missed).alias("RejectReasons"))


def split_resolved(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``resolve_keys`` whose keys were all found, and the rejects with their reasons."""
    return df.filter("RejectReasons IS NULL").drop("RejectReasons"), df.filter("RejectReasons IS NOT NULL")


def aggregate_children(parent: DataFrame, children: DataFrame, key: str,
                       measures: dict[str, Column]) -> DataFrame:
    """Child rows summed per parent key (pre-aggregated), then joined.

    Parents without children keep NULL measures.
    """
    agg = children.groupBy(key).agg(*[expr.alias(name) for name, expr in measures.items()])
    return parent.join(agg, key, "left")


def weather_match(flights: DataFrame, observations: DataFrame, weather_dim: DataFrame,
                  severity_map: dict[str, str] | None = None) -> DataFrame:
    """Attach the hourly observation of the departure airport to each flight.

    Equi-join on (airport, hour of departure); several observations in one
    hour are reduced to the latest first (ties broken by condition, then
    severity, so the choice is deterministic), so the join cannot multiply rows.
    The observation's condition/severity (mapped by ``severity_map``) is
    looked up in the weather dimension to give WeatherKey.
    """
    obs = observations.withColumn("__hour", F.date_trunc("hour", F.col("timestamp")))
    latest = obs.groupBy("airport_code", "__hour").agg(
        F.max(F.struct("timestamp", "condition", "severity")).alias("__o"))
    sev = F.col("__o.severity")
    if severity_map:
        mapping = F.create_map(*[F.lit(x) for kv in severity_map.items() for x in kv])
        sev = F.coalesce(mapping[sev], sev)
    latest = latest.select("airport_code", F.col("__hour").alias("__ohour"),
                           F.col("__o.condition").alias("__cond"), sev.alias("__sev"))
    keys = weather_dim.select(F.col("WeatherCondition").alias("__cond"),
                              F.col("Severity").alias("__sev"), "WeatherKey")
    latest = latest.join(keys, ["__cond", "__sev"], "left")
    f = flights.withColumn("__hour", F.date_trunc("hour", F.col("departure_time")))
    j = f.join(latest, (f["departure_airport"] == latest["airport_code"])
               & (f["__hour"] == latest["__ohour"]), "left")
    return j.drop("airport_code", "__hour", "__ohour", "__cond", "__sev")


def as_report(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE, for registered outputs (exact values kept)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])
