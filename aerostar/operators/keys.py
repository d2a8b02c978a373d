"""Dense, ordered surrogate keys without a single-task global sort.

``row_number()`` over an un-partitioned window moves every row into one task.
Instead the rows are range-partitioned on the order columns, sorted inside
each partition and checkpointed to the shared checkpoint folder (so a lost
executor cannot reshuffle rows between the two passes).  A tiny per-partition
count then gives each partition its offset, and every row gets
``start + offset(partition) + position-in-partition``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostar.session import checkpoint_dir

_PID, _POS = "__pid", "__pos"


def assign_keys(df: DataFrame, key: str, order: list[str | Column], start: Column | int = 0,
                partitions: int | None = None) -> DataFrame:
    """Add ``key`` = start + 1, start + 2, ... in the order of ``order``.

    ``start`` may be a Column (for example a scalar subquery of the current
    MAX key).  The result is deterministic given the order columns.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn(_PID, F.spark_partition_id())
              # Position inside the partition: the low 33 bits of the id.
              .withColumn(_POS, F.monotonically_increasing_id()
                          - (F.col(_PID).cast("long") * F.lit(1 << 33))))
    fixed = ranged.checkpoint(eager=True)
    counts = fixed.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: a window over ``n`` rows, broadcast back.
    offsets = counts.select(_PID, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    base = start if isinstance(start, Column) else F.lit(start)
    return (fixed.join(F.broadcast(offsets), _PID)
            .withColumn(key, base.cast("long") + F.col("__off") + F.col(_POS) + 1)
            .drop(_PID, _POS, "__off"))
