"""Helpers shared by the corpus operators: input columns, staging, prefix sums."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerostar.session import checkpoint_dir

#: A word is a run of characters outside this class (ASCII white space).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, by exact spelling and first occurrence.

    Extra columns, also those that differ only in case or repeat a name,
    can't make a later reference ambiguous.
    """
    at = [df.columns.index(n) for n in names]
    flat = df.toDF(*[f"_in{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_in{i}").alias(n) for i, n in zip(at, names, strict=True)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the tasks of the next step only.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for df in frames:
        spark, path = df.sparkSession, getattr(df, "_staged_path", None)
        if path:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality on ``names``."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sums(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                 out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` up to and with this row, in ``order`` within ``group``.

    Rows are dealt by range over (group, order), so one group that holds a
    third of all rows is spread over many tasks. Each range sums its own rows;
    the window over whole groups runs on one row per (group, range). ``order``
    must make ties harmless: rows equal in it are taken in any order.
    """
    dealt = stage(df.repartitionByRange(*[F.col(c) for c in [*group, *order]])
                  .withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    kind = "decimal(38,0)"
    starts = (dealt.groupBy(*group, "_range").agg(F.sum(F.col(value).cast(kind)).alias("_part"))
              .withColumn("_start", F.coalesce(F.sum("_part").over(before), F.lit(0)).cast(kind))
              .drop("_part"))
    own = (Window.partitionBy(*group, "_range").orderBy(*order)
           .rowsBetween(Window.unboundedPreceding, 0))
    local = dealt.withColumn("_own", F.sum(F.col(value).cast(kind)).over(own))
    joined = local.join(starts, same(local, starts, [*group, "_range"]))
    keep = [local[c] for c in df.columns]
    return joined.select(*keep, (F.col("_own") + F.col("_start")).cast(kind).alias(out))
