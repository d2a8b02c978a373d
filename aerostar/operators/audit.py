"""Audit trail (P17): run metrics gathered while the data is written.

Counts come from ``Observation`` metrics attached to the DataFrames being
written, so they cost no extra pass; the three log tables of the document
(run log, error records, data-quality results) are appended as Parquet.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostar.operators.upsert import collapse_batch

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])


def audited_load(spark: SparkSession, job: str, valid: DataFrame, rejected: DataFrame,
                 out_path: str, log_dir: str, dq: DataFrame | None = None,
                 mode: str = "overwrite") -> dict:
    """Write ``valid`` to ``out_path``, rejected rows to the error log, and
    append one run-log row (and the DQ rows) -- all counted on the executors."""
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    ok_obs, bad_obs = Observation(f"{job}_valid"), Observation(f"{job}_rejected")
    status, error = "success", None
    written = rejected_n = 0
    try:
        valid.observe(ok_obs, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(out_path)
        (rejected.observe(bad_obs, F.count(F.lit(1)).alias("n"))
         .withColumn("job", F.lit(job)).withColumn("logged_at", F.lit(started))
         .write.mode("append").parquet(f"{log_dir}/etl_error_log"))
        written, rejected_n = ok_obs.get["n"], bad_obs.get["n"]
        if dq is not None:
            (dq.withColumn("job", F.lit(job)).withColumn("checked_at", F.lit(started))
             .write.mode("append").parquet(f"{log_dir}/data_quality_log"))
    except Exception as exc:  # the failure itself is part of the audit trail
        status, error = "failed", str(exc)
    ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = (job, started, ended, int(written), int(rejected_n), status, error)
    spark.createDataFrame([row], RUN_LOG_SCHEMA).write.mode("append").parquet(
        f"{log_dir}/etl_audit_log")
    if error:
        raise RuntimeError(error)
    return dict(zip(RUN_LOG_SCHEMA.names, row))


AUDIT_SCHEMA = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_updated", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("watermark_key", T.LongType()),
    T.StructField("watermark_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])
ACTION = "LoadAction"


def classified(target_keys: DataFrame, valid: DataFrame, rejected: DataFrame, key: str, update_cols, insert_cols,
               seq: str, time: str) -> DataFrame:
    """What a load does with a batch: a row for each key (insert or update) and for each rejected record.

    ``SourceRows`` is how many records a row stands for: of a new key the
    first one inserts and the others update; ``SourceTime`` is their latest
    ``time``. Known keys are found by a join on the key column alone.
    """
    counts = valid.groupBy(key).agg(F.count(F.lit(1)).alias("SourceRows"), F.max(time).alias("SourceTime"))
    loads = collapse_batch(valid, key, list(update_cols), list(insert_cols), seq).join(counts, key)
    known = target_keys.select(F.col(key).alias("_known")).distinct()
    loads = loads.join(known, F.col(key) == F.col("_known"), "left")
    action = F.when(F.col("_known").isNull(), "insert").otherwise("update")
    loads = loads.withColumn(ACTION, action).drop("_known")
    bad = rejected.drop(seq).withColumns({"SourceRows": F.lit(1).cast("long"), "SourceTime": F.col(time), ACTION: F.lit("reject")})
    return loads.unionByName(bad, allowMissingColumns=True)


def audited_upsert(spark: SparkSession, job: str, target_keys: DataFrame, valid: DataFrame, rejected: DataFrame,
                   out_path: str, log_dir: str, key: str, update_cols, insert_cols, seq: str, time: str,
                   dq: DataFrame | None = None) -> dict:
    """One classified write of a batch and its entries in the three log tables.

    The write is partitioned by LoadAction (insert, update, reject); one
    Observation on it gives records processed, inserted, updated and rejected
    and the watermark, the largest (``time``, key) of the batch.
    As it is one job, a failure leaves no part of the batch loaded, and the
    entry says failed. Rejected records are copied with their reason to
    ``etl_error_log``, ``dq`` rows go to ``data_quality_log``, and
    ``etl_audit_log`` gets the run.
    """
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    seen = Observation(f"{job}_{started:%H%M%S%f}")
    n, action = F.col("SourceRows"), F.col(ACTION)
    total = lambda cond, value: F.coalesce(F.sum(F.when(cond, value)), F.lit(0))
    got, status, error = {}, "success", None
    try:
        rows = classified(target_keys, valid, rejected, key, update_cols, insert_cols, seq, time)
        (rows.observe(seen, F.coalesce(F.sum(n), F.lit(0)).alias("rows_processed"),
                      total(action == "insert", F.lit(1)).alias("rows_inserted"),
                      total(action != "reject", n - F.when(action == "insert", 1).otherwise(0)).alias("rows_updated"),
                      total(action == "reject", n).alias("rows_rejected"),
                      F.max(F.struct(F.col("SourceTime").cast("long"), F.col(key).cast("long"))).alias("mark"))
         .write.partitionBy(ACTION).parquet(out_path))
        got = seen.get
        stamp = {"job": F.lit(job), "logged_at": F.lit(started)}
        (spark.read.schema(rows.schema).parquet(out_path).filter(action == "reject").drop(ACTION, "SourceRows", "SourceTime").withColumns(stamp)
         .write.mode("append").parquet(f"{log_dir}/etl_error_log"))
        if dq is not None:
            dq.withColumns({"job": F.lit(job), "checked_at": F.lit(started)}).write.mode("append").parquet(
                f"{log_dir}/data_quality_log")
    except Exception as exc:  # the failure itself is part of the audit trail
        status, error = "failed", str(exc)
    mark = list(got["mark"]) if got.get("mark") is not None else [None, None]
    ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    entry = (job, started, ended, *[int(got.get(c, 0)) for c in AUDIT_SCHEMA.names[3:7]], *mark, status, error)
    spark.createDataFrame([entry], AUDIT_SCHEMA).write.mode("append").parquet(f"{log_dir}/etl_audit_log")
    if error:
        raise RuntimeError(error)
    return dict(zip(AUDIT_SCHEMA.names, entry, strict=True))
