"""Mixing sources to target weights by systematic sampling (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostar.llm.common import pick, running_sums, same, stage, word_count

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix-1"
#: Expected copies are counted in units of 1/UNIT, so that sums are exact.
UNIT = 1 << 30
#: The random offset of a source is drawn so often, evenly spaced; the draw
#: whose words come nearest to the target is the one that is used.
DRAWS = 16


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS,
                   cap: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target: one row per source of ``sized`` (source, size).

    The share of a source is w * level, stopped at cap * size. With sources in
    the order of cap * size / w, the level that hands out everything is the
    largest of (rest after the sources before) / (their weights from here on).
    The windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((rank - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("room", F.col("source_size") * cap)
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("room") / F.col("w"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0))
    open_w = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    per = per.withColumn("level", rest / open_w)
    level = F.max("level").over(everything)
    return per.select("source", "source_size",
                      F.least(F.col("room").cast("double"), F.col("w") * level).alias("target"))


def copies(docs: DataFrame, seed: str = SEED, weights: Sequence[int] = WEIGHTS,
           cap: int = MAX_COPIES) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies.

    Every document of a source expects target / source_size copies. The
    expectations are summed up within the source, one random offset is added,
    and a copy is taken for each integer boundary that a document's step
    crosses: at most ``cap``. Documents stand in order of size, then of a
    hash of their id, so the words taken differ from the target by about one
    longest document at most, whatever the offset; of DRAWS evenly spaced
    offsets the one that comes nearest is used.

    Cases: null text has size 0; a null source is a source of its own, last
    in order; a source without words has target 0 and gives no copies;
    repeated rows are taken in any order, which can't be told apart; an empty
    table gives no rows. The offset and the order are hashes of ``seed``, so
    reruns agree.
    """
    tie = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")).cast("binary"))
    sized = (pick(docs, "doc_id", "source", "text")
             .select("doc_id", "source", word_count(F.col("text")).alias("size"), tie.alias("tie")))
    goals = source_targets(sized, weights, cap)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sized.join(goals, same(sized, goals, ["source"])).drop(goals["source"])
    joined = joined.withColumn("step", F.floor(rate * F.lit(float(UNIT))).cast("long"))
    summed = running_sums(joined, ["source"], ["size", "tie", "doc_id"], "step", "reach")
    # Whole units before a document don't matter to the boundaries it crosses.
    summed = stage(summed.withColumn("lo", ((F.col("reach") - F.col("step")) % UNIT).cast("long"))
                   .drop("reach", "tie"), "mix-steps")
    name = F.concat_ws("|", F.lit(seed), F.coalesce("source", F.lit("")),
                       F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.lit("")))
    first = F.conv(F.substring(F.md5(name.cast("binary")), 1, 7), 16, 10).cast("long") * 4

    def draw(k: int):
        return (first + k * (UNIT // DRAWS)) % UNIT

    def crossed(start):
        whole = F.lit(UNIT).cast("long")
        return (F.floor((F.col("lo") + F.col("step") + start) / whole)
                - F.floor((F.col("lo") + start) / whole)).cast("long")

    tried = summed.groupBy("source").agg(
        F.first("target").alias("goal"),
        *[F.sum(F.col("size") * crossed(draw(k))).alias(f"take{k}") for k in range(DRAWS)])
    nearest = F.least(*[F.struct(F.abs(F.col(f"take{k}") - F.col("goal")).alias("off"),
                                 F.lit(k).alias("k")) for k in range(DRAWS)])["k"]
    tried = tried.select(F.col("source").alias("of"), nearest.alias("k"))
    chosen = summed.join(tried, summed["source"].eqNullSafe(tried["of"]))
    start = (first + F.col("k") * (UNIT // DRAWS)) % UNIT
    return chosen.select("doc_id", "source", "size", "source_size", "target",
                         crossed(start).alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it."""
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {n: f"c{docs.columns.index(n)}" for n in ("doc_id", "source", "text")}
    print_ = F.xxhash64(F.coalesce(F.col(at["text"]), F.lit("")))
    rows = rows.withColumn("_print", print_)
    taken = copies(docs, **options).groupBy("doc_id", "source", "size").agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_same"))
    keyed = rows.withColumn("_size", word_count(F.col(at["text"])))
    joined = keyed.join(taken.filter("_copies > 0"),
                        keyed[at["doc_id"]].eqNullSafe(taken["doc_id"])
                        & keyed[at["source"]].eqNullSafe(taken["source"])
                        & (keyed["_size"] == taken["size"]))
    # Rows that agree in id, source and size share their copies in a fixed order.
    twin = Window.partitionBy(keyed[at["doc_id"]], keyed[at["source"]], "_size").orderBy("_print")
    nth = F.row_number().over(twin)
    joined = joined.withColumn("_nth", nth)
    own = F.expr("CAST(_copies div _same + CASE WHEN _nth <= _copies % _same THEN 1 ELSE 0 END AS INT)")
    out = (joined.withColumn("_own", own).filter("_own > 0")
           .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_own")))))
    return out.select(*[keyed[f"c{i}"].alias(n) for i, n in enumerate(docs.columns)])


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    rows = copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1|' || CAST(doc_id AS VARCHAR)) AS tie
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT source, source_size, w,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER fill, 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER fill, 0)) AS level
  FROM per
  WINDOW fill AS (ORDER BY 3 * source_size / w, source ASC NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size,
         least(CAST(3 * source_size AS DOUBLE), w * max(level) OVER ()) AS target
  FROM levels),
steps AS (
  SELECT s.doc_id, s.source, s.size, s.tie, g.source_size, g.target,
         CASE WHEN g.source_size > 0
              THEN CAST(floor(g.target / g.source_size * 1073741824.0::DOUBLE) AS BIGINT) ELSE 0 END AS step,
         CAST('0x' || substr(md5('mix-1|' || coalesce(s.source, '') || '|'
              || CASE WHEN s.source IS NULL THEN 'null' ELSE '' END), 1, 7) AS BIGINT) * 4 AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
reach AS (
  SELECT *, (sum(step) OVER (PARTITION BY source ORDER BY size, tie, doc_id
                             ROWS UNBOUNDED PRECEDING) - step) % 1073741824 AS lo
  FROM steps),
draws AS (
  SELECT r.source, k, (any_value(start) + k * 67108864) % 1073741824 AS begin_at,
         abs(sum(size * ((lo + step + (start + k * 67108864) % 1073741824) // 1073741824
                         - (lo + (start + k * 67108864) % 1073741824) // 1073741824))
             - any_value(target)) AS off
  FROM reach r, range(16) t(k)
  GROUP BY r.source, k),
best AS (
  SELECT source, begin_at FROM draws
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, k) = 1)
SELECT r.doc_id, r.size, r.source_size, r.target,
       CAST(((lo + step + begin_at) // 1073741824 - (lo + begin_at) // 1073741824) * size AS BIGINT) AS taken
FROM reach r JOIN best b ON r.source IS NOT DISTINCT FROM b.source
"""
