"""Slowly changing dimension type 2 (E04, P11) and point-in-time lookup.

``scd2_apply`` turns the original's record-by-record loop (look up the
current row, compare, expire + insert) into joins and windows:

* each batch row is compared (NULL-safe, like Python ``!=``) with the row
  before it for the same business key in ``seq`` order, the first one with
  the current dimension row;
* every row whose tracked tuple differs opens a version; the last opened
  version of a key is current, earlier ones are closed the same day;
* current rows of keys that opened a version are expired;
* new surrogate keys continue after MAX(key), in batch order.

Hot keys: the batch is range-partitioned on (business key, seq) and
checkpointed, so the predecessor of a row is found inside its partition, and
only the last tuple per (partition, key) crosses partitions -- no task ever
holds all rows of one key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostar.functions.dates import DEFAULT_AS_OF
from aerostar.operators.keys import assign_keys
from aerostar.session import checkpoint_dir

# Attributes the original writes into a new customer version; the others
# become NULL unless ``carry_forward`` (fixed list).
CUSTOMER_VERSION_COLS = ("CustomerID", "FirstName", "LastName", "Email", "LoyaltyTier",
                         "LoyaltyPoints")
# Fixed values of the original: the attributes whose change opens a version.
CUSTOMER_TRACKED = ("LoyaltyTier", "Email")


def _changes(batch: DataFrame, current: DataFrame, business_key: str, tracked: list[str],
             seq: str) -> DataFrame:
    """Batch rows that open a new version, with ``__last`` marking the final one.

    ``current`` holds one row per business key with its tracked tuple ``__cur``.
    """
    spark = batch.sparkSession
    checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = F.struct(*[F.col(c) for c in tracked])
    ranged = (batch.withColumn("__t", t)
              .repartitionByRange(n, business_key, seq)
              .withColumn("__pid", F.spark_partition_id())
              .checkpoint(eager=True))
    in_part = Window.partitionBy("__pid", business_key).orderBy(seq)
    local = ranged.withColumn("__prev", F.lag("__t").over(in_part))
    # Last tuple of each (partition, key) and the one of the partition before.
    last = ranged.groupBy("__pid", business_key).agg(F.max_by("__t", F.col(seq)).alias("__lt"))
    carry = last.withColumn(
        "__carry", F.lag("__lt").over(Window.partitionBy(business_key).orderBy("__pid"))) \
        .select("__pid", business_key, "__carry")
    j = (local.join(carry, ["__pid", business_key], "left")
         .join(current, business_key, "left"))
    pred = F.coalesce(F.col("__prev"), F.col("__carry"), F.col("__cur"))
    opens = j.filter(pred.isNull() | ~F.col("__t").eqNullSafe(pred))
    last_seq = opens.groupBy(business_key).agg(F.max(seq).alias("__lseq"))
    return (opens.join(last_seq, business_key)
            .withColumn("__last", F.col(seq) == F.col("__lseq"))
            .drop("__t", "__prev", "__carry", "__cur", "__lseq", "__pid"))


def scd2_apply(dim: DataFrame, batch: DataFrame, business_key: str = "CustomerID",
               tracked=CUSTOMER_TRACKED, as_of: dt.date = DEFAULT_AS_OF,
               surrogate_key: str = "CustomerKey", seq: str = "seq",
               version_cols=CUSTOMER_VERSION_COLS, carry_forward: bool = False) -> DataFrame:
    """Apply a batch of records to a type-2 dimension; returns the new dimension.

    ``carry_forward=False`` reproduces the original: attributes outside
    ``version_cols`` are NULL in a new version.  ``True`` copies them from
    the version being replaced.  Points-only changes (untracked) are ignored.
    """
    tracked = list(tracked)
    current = dim.filter(F.col("IsCurrent"))
    # One current version per key; with several, the highest surrogate key wins.
    cur_one = current.groupBy(business_key).agg(
        F.max_by(F.struct(*[F.col(c) for c in tracked]), F.col(surrogate_key)).alias("__cur"))
    opens = _changes(batch, cur_one, business_key, tracked, seq)
    today = F.lit(as_of)

    changed_keys = opens.select(business_key).distinct().withColumn("__chg", F.lit(True))
    flagged = dim.join(changed_keys, business_key, "left")
    expire = F.col("IsCurrent") & F.col("__chg").isNotNull()
    history = flagged.select(*[
        (F.when(expire, F.lit(False)).otherwise(F.col(c)) if c == "IsCurrent" else
         F.when(expire, today).otherwise(F.col(c)) if c == "ExpirationDate" else F.col(c)).alias(c)
        for c in dim.columns])

    keep = [c for c in version_cols if c in batch.columns]
    rows = opens.select(business_key, seq, "__last", *[c for c in keep if c != business_key])
    if carry_forward:
        prev = current.groupBy(business_key).agg(
            F.max_by(F.struct(*[F.col(c).alias(f"__p_{c}") for c in dim.columns]),
                     F.col(surrogate_key)).alias("__prev_row"))
        rows = rows.join(prev.select(business_key, "__prev_row.*"), business_key, "left")
    start = dim.select(F.coalesce(F.max(surrogate_key), F.lit(0))).scalar()
    keyed = assign_keys(rows, surrogate_key, [seq, business_key], start=start)

    def value(c: str) -> Column:
        if c == surrogate_key:
            return F.col(c)
        if c in keep:
            return F.col(c)
        if c == "EffectiveDate":
            return today
        if c == "ExpirationDate":
            return F.when(F.col("__last"), F.lit(None).cast("date")).otherwise(today)
        if c == "IsCurrent":
            return F.col("__last")
        if carry_forward:
            return F.col(f"__p_{c}")
        return F.lit(None)

    versions = keyed.select(*[value(c).cast(dim.schema[c].dataType).alias(c) for c in dim.columns])
    return history.unionByName(versions)


def point_in_time(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                  fact_date: str, out_cols: list[str]) -> DataFrame:
    """Attach the dimension version valid on the fact's date.

    Equi-join on the business key plus the range condition
    ``EffectiveDate <= d AND (ExpirationDate IS NULL OR d < ExpirationDate)``;
    the equality part keeps it a hash/sort-merge join, never a cartesian one.
    Same-day versions (EffectiveDate = ExpirationDate) never match.
    """
    d = dim.select(F.col(dim_key).alias("__bk"), F.col("EffectiveDate").alias("__eff"),
                   F.col("ExpirationDate").alias("__exp"), *out_cols)
    cond = ((facts[fact_key] == d["__bk"]) & (d["__eff"] <= facts[fact_date])
            & (d["__exp"].isNull() | (facts[fact_date] < d["__exp"])))
    return facts.join(d, cond, "left").drop("__bk", "__eff", "__exp")
