"""Packing: length buckets by dynamic programming, token-budget batches inside each bucket."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.llm.common import pick, running_sums, word_count

BUCKETS = 16
TOKEN_BUDGET = 65_536
#: Lengths up to this are bucket ends of their own; longer ones are rounded up
#: to 1/1024 of their size, which bounds the histogram (65,536 + 1,024 rows per doubling).
EXACT_LENGTHS = 1 << 16


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least total padding.

    ``lengths`` ascend. A bucket over bins i+1..j pads every row to
    lengths[j]. The cost satisfies the quadrangle inequality, so the best
    cut of a layer moves monotonically and each layer is solved by halving.
    """
    m = len(lengths)
    if m == 0:
        return []
    rows = np.concatenate([[0], np.cumsum(counts, dtype=np.float64)])
    ends = lengths.astype(np.float64)
    # Padding differs from padded size by the constant number of tokens.
    best = ends * rows[1:]
    cuts = []
    for _ in range(1, min(buckets, m)):
        prior = np.concatenate([[0.0], best])
        now, cut = np.empty(m), np.zeros(m, dtype=np.int64)
        todo = [(0, m - 1, 0, m - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j) + 1)
            cost = prior[i] + ends[j] * (rows[j + 1] - rows[i])
            at = int(np.argmin(cost))
            now[j], cut[j] = cost[at], a + at
            todo += [(lo, j - 1, a, a + at), (j + 1, hi, a + at, b)]
        cuts.append(cut)
        best = now
    out, j = [], m - 1
    for cut in reversed(cuts):
        out.append(int(lengths[j]))
        j = int(cut[j]) - 1
        if j < 0:
            return sorted(out)
    out.append(int(lengths[j]))
    return sorted(out)


def length_bin(length):
    """The length itself, or its upper edge on a grid of 1/1024 when it is long."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))) - 10)
    return F.when(length <= EXACT_LENGTHS, length).otherwise(
        (F.ceil(length / step) * step).cast("long"))


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, bucket, padded_len, batch, slot.

    Tokens are words. The driver sees one row per length of the histogram of
    all rows (bounded by EXACT_LENGTHS), never rows. A batch of a bucket holds
    budget // padded_len rows (one at least, so a text longer than the budget
    is a batch of its own); batches are filled in the order of a hash of the
    id, and all but the last of a bucket are full.

    Cases: null and empty texts have 0 tokens and are packed like any other
    length; repeated rows each get a slot; an empty table gives no rows.
    """
    sized = pick(docs, "doc_id", "text").select("doc_id", word_count(F.col("text")).alias("n_tokens"))
    histogram = (sized.groupBy(length_bin(F.col("n_tokens")).alias("len")).count()
                 .orderBy("len").toPandas())
    bounds = best_bounds(histogram["len"].to_numpy(dtype=np.int64),
                         histogram["count"].to_numpy(dtype=np.int64), buckets) or [0]
    bucket, width = F.lit(len(bounds) - 1), F.lit(bounds[-1])
    for i in reversed(range(len(bounds) - 1)):
        fits = F.col("n_tokens") <= bounds[i]
        bucket = F.when(fits, i).otherwise(bucket)
        width = F.when(fits, bounds[i]).otherwise(width)
    rows = sized.select("doc_id", "n_tokens", bucket.cast("int").alias("bucket"),
                        width.cast("long").alias("padded_len"),
                        F.xxhash64("doc_id").alias("tie"), F.lit(1).alias("one"))
    ranked = running_sums(rows, ["bucket"], ["tie", "doc_id", "n_tokens"], "one", "rank")
    place = (F.col("rank") - 1).cast("long")
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("padded_len"), F.lit(1))))
    return (ranked.withColumn("place", place).withColumn("room", room.cast("long"))
            .select("doc_id", "n_tokens", "bucket", "padded_len",
                    F.expr("place div room").alias("batch"), (F.col("place") % F.col("room")).alias("slot")))


def op1_pack_batches(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
