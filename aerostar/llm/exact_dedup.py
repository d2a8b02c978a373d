"""Exact dedup: 128-bit content hash, smallest id stays, bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostar.llm.common import SPACE, pick, stage

#: Parts into which the byte comparison of one group is dealt.
SALTS = 32
#: Groups (24 bytes of key and id each) up to which their keys are broadcast: some 10 MB.
BROADCAST_GROUPS = 100_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_classes(docs: DataFrame, digest: Callable[[Column], Column] = _digest) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space has
    become one space; null counts as empty. ``digest`` (128 bits) only brings
    candidates together: inside each group the smallest and the largest text
    are compared byte by byte, and a group that holds more than one text is
    divided by the text itself, so a collision never merges two texts.

    Cases: empty table gives no rows. A null doc_id never becomes keep_id
    while its group has another; a group of null ids only has keep_id null,
    and its rows are kept = false except when the group is a single row.
    Rows that repeat both id and text are one document: all carry the same
    answer. ``deduplicate`` returns it once.
    """
    base = pick(docs, "doc_id", "text").select("doc_id", normalised(F.col("text")).alias("body"))
    base = base.withColumn("h", digest(F.col("body")))
    keys = stage(base.select("doc_id", "h", F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("sha")),
                 "dedup-keys")
    multi = stage(keys.groupBy("h").agg(F.min("doc_id").alias("keep"), F.count(F.lit(1)).alias("n"))
                  .filter("n > 1"), "dedup-groups")

    # Byte check. A group is dealt over SALTS parts; each part keeps two texts.
    ends = [F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    rows = base.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    if multi.count() <= BROADCAST_GROUPS:
        rows = rows.join(F.broadcast(multi.select("h")), "h", "left_semi")
    else:
        salted = multi.select("h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        rows = rows.join(salted.hint("merge"), ["h", "salt"], "left_semi")
    clash = (rows.groupBy("h", "salt").agg(F.min("body").alias("lo"), F.max("body").alias("hi"))
             .groupBy("h").agg(*ends).filter("lo <> hi").select("h"))
    clash = stage(clash, "dedup-clash")

    def answer(rows: DataFrame) -> DataFrame:
        size = F.coalesce("n", F.lit(1)).cast("long")
        keep = F.when(size == 1, F.col("doc_id")).otherwise(F.col("keep"))
        return rows.select("doc_id", keep.alias("keep_id"), size.alias("group_size"),
                           F.coalesce(keep == F.col("doc_id"), size == 1).alias("kept"),
                           F.lower(F.hex("sha")).alias("text_sha256"))

    if clash.isEmpty():
        return answer(keys.join(multi, "h", "left"))
    apart = base.join(clash, "h", "left_semi")
    by_text = (apart.groupBy("h", "body")
               .agg(F.min("doc_id").alias("keep"), F.count(F.lit(1)).alias("n")))
    sha = F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("sha")
    return answer(keys.join(clash, "h", "left_anti").join(multi, "h", "left")).unionByName(
        answer(apart.join(by_text, ["h", "body"]).select("doc_id", "keep", "n", sha)))


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM norm
"""
