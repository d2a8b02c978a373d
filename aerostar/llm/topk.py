"""Exact top-k inner products: norm buckets, coordinate or length pruning, verified products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostar.llm.common import pick, stage

TOP, EVERY = 5, 50
#: Buckets of like length, and the most vectors that one block of a bucket holds.
BUCKETS, BLOCK, QUERY_BUCKETS, QUERY_BLOCK = 64, 2048, 8, 256
#: Blocks of a bucket that queries meet together: a long bucket has more such groups, not larger ones.
GROUP = 16
#: Cosine threshold from which coordinates prune; below it the length does.
COORDINATES_FROM = 0.55
FOCUS = 3
EXACT = float(2**53)
BLOCK_SCHEMA = "no int, ids binary, dim int, data binary, norms binary, top double"
VECTOR_SCHEMA = "vec_id long, norm double, data binary"


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components x become floor(256 * x), held exactly as doubles."""
    for batch in batches:
        ids, norms, data = [], [], []
        for vec_id, values in zip(batch["vec_id"], batch["embedding"], strict=True):
            if any(v is None for v in values):
                continue
            x = np.floor(np.asarray(values, dtype=np.float64) * 256.0)
            if not np.isfinite(x).all():
                continue
            ids.append(vec_id)
            data.append(x.tobytes())
            top = np.abs(x).max(initial=0.0)
            norms.append(float(np.sqrt(((x / top) ** 2).sum()) * top) if top else 0.0)
        yield pd.DataFrame({"vec_id": np.array(ids, dtype=np.int64), "norm": np.array(norms, dtype=np.float64),
                            "data": data})


def _packer(limit: int):
    """Rows of a range, longest first, into blocks of at most ``limit`` vectors."""
    def pack(ids, norms, data, no):
        dim = max(len(d) for d in data) // 8
        flat = np.zeros((len(ids), dim))
        for row, d in zip(flat, data, strict=True):
            row[: len(d) // 8] = np.frombuffer(d)
        return {"no": no, "ids": np.array(ids, dtype=np.int64).tobytes(), "dim": dim, "data": flat.tobytes(),
                "norms": np.array(norms, dtype=np.float64).tobytes(), "top": norms[0]}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, norms, data, no = [], [], [], 0
        for batch in batches:
            ids += batch["vec_id"].tolist()
            norms += batch["norm"].tolist()
            data += batch["data"].tolist()
            while len(ids) >= limit:
                yield pd.DataFrame([pack(ids[:limit], norms[:limit], data[:limit], no)])
                ids, norms, data, no = ids[limit:], norms[limit:], data[limit:], no + 1
        if ids:
            yield pd.DataFrame([pack(ids, norms, data, no)])
    return run


def _blocks(vectors: DataFrame, buckets: int, limit: int, label: str) -> DataFrame:
    dealt = (vectors.repartitionByRange(buckets, F.col("norm").desc(), "vec_id")
             .sortWithinPartitions(F.col("norm").desc(), "vec_id"))
    packed = dealt.mapInPandas(_packer(limit), BLOCK_SCHEMA)
    return stage(packed.withColumn("bucket", F.spark_partition_id()), label)


def _open(row, prefix: str = ""):
    ids = np.frombuffer(row[f"{prefix}ids"], dtype=np.int64)
    return ids, np.frombuffer(row[f"{prefix}data"]).reshape(len(ids), row[f"{prefix}dim"]), np.frombuffer(row[f"{prefix}norms"])


def _products(q: np.ndarray, c: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products; as Python integers where doubles don't hold them."""
    d = min(q.shape[1], c.shape[1])
    if bound < EXACT:
        return q[:, :d] @ c[:, :d].T
    whole = lambda m: np.array([[int(v) for v in r] for r in m[:, :d]], dtype=object).reshape(len(m), d)
    return whole(q) @ whole(c).T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest, ties to the smaller id."""
    if len(scores) > k and scores.dtype != object:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= kth)
    else:
        at = np.arange(len(scores))
    return np.array(sorted(at, key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)


def _retrieve(queries, block, floors: np.ndarray, k: int):
    """(query place, candidate ids, scores) of one block for the queries that it can serve."""
    qids, q, qnorm = queries
    ids, c, norms = block
    if not len(ids):
        return
    slack = 1.0 - 1e-9
    bound = float(qnorm.max()) * float(norms[0])
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        reach = qnorm * norms[0]
        local = np.where(reach > 0, floors / reach, np.where(floors > 0, 2.0, -1.0)) * slack
    alive = np.flatnonzero((local <= 1.0) | ~np.isfinite(bound))
    by_axis = [i for i in alive if local[i] >= COORDINATES_FROM and bound < EXACT]
    by_length = np.array([i for i in alive if local[i] < COORDINATES_FROM or bound >= EXACT], dtype=np.int64)

    def answer(i, places, scores):
        fit = np.flatnonzero((scores >= floors[i]) & (ids[places] != qids[i]))
        if len(fit):
            at = fit[_best(scores[fit], ids[places][fit], k)]
            yield i, ids[places][at], scores[at]

    if len(by_length):
        # Longest first: what is too short for the weakest query is cut off as a prefix.
        need = np.where(qnorm[by_length] > 0, floors[by_length] / np.maximum(qnorm[by_length], 1e-300), -np.inf).min()
        n = int(np.searchsorted(-norms, -need * slack, side="right")) if bound < EXACT and need > 0 else len(ids)
        scores = _products(q[by_length], c[:n], bound)
        for row, i in zip(scores, by_length, strict=True):
            yield from answer(i, np.arange(n), row)
    if by_axis:
        unit = c / np.maximum(norms, 1e-300)[:, None]
        for i in by_axis:
            u = q[i] / qnorm[i]
            places = np.arange(len(ids))
            for f in np.argsort(-np.abs(u))[:FOCUS]:
                if f >= c.shape[1]:
                    continue
                a, b = np.arccos(np.clip(u[f], -1, 1)), np.arccos(np.clip(local[i], -1, 1))
                lo, hi = np.cos(min(np.pi, a + b)) - 1e-9, np.cos(max(0.0, a - b)) + 1e-9
                x = unit[places, f]
                places = places[(x >= lo) & (x <= hi)]
            if len(places):
                yield from answer(i, places, _products(q[i:i + 1], c[places], bound)[0])


def _long(x) -> int:
    return max(-(2**63), min(2**63 - 1, int(x)))


def top_k(rows: DataFrame, is_query: Column, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each query.

    ``rows`` has vec_id and embedding. Vectors are put into BUCKETS ranges of
    length and packed into blocks. The block of the longest vectors gives each
    query a first k-th score; GROUP blocks of a bucket are skipped for queries
    whose length times theirs can't reach that score. In the others the local cosine
    threshold chooses: high, and the query's FOCUS largest coordinates bound
    the coordinates of what can qualify; low, and the shorter end is cut off.
    What is left is multiplied out.

    Cases: vectors that are null, hold null or non-finite components, or have
    a null id take no part; an empty vector scores 0; of unlike lengths the
    missing components count as 0; ties go to the smaller id; rows that share
    the query's id are its own; repeated rows are candidates each; scores
    beyond a long stop at its ends; without queries there are no rows.
    """
    valid = (pick(rows, "vec_id", "embedding").filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
             .withColumn("embedding", F.col("embedding").cast("array<double>")))
    vectors = stage(valid.mapInPandas(_vectors, VECTOR_SCHEMA), "topk-vectors")
    blocks = _blocks(vectors, BUCKETS, BLOCK, "topk-blocks")
    queries = _blocks(vectors.filter(is_query), QUERY_BUCKETS, QUERY_BLOCK, "topk-queries")
    as_query = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("ids", "dim", "data", "norms")])
    # Three numbers for each GROUP * BLOCK vectors: bucket, group and its largest length.
    tops = [(r.bucket, r.no // GROUP, r.top) for r in
            blocks.filter(F.col("no") % GROUP == 0).select("bucket", "no", "top").collect()]
    # One block, of the longest vectors: all that is ever sent to every task.
    longest = blocks.filter((F.col("no") == 0) & (F.col("bucket") == min((b for b, _, _ in tops), default=-1))).select(
        "ids", "dim", "data", "norms")

    def seed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            floors = []
            for row in batch.to_dict("records"):
                qs = _open(row, "q_")
                low = np.full(len(qs[0]), -np.inf)
                for i, _, scores in _retrieve(qs, _open(row), low.copy(), k):
                    if len(scores) == k:
                        low[i] = float(scores[-1]) if abs(scores[-1]) < EXACT else -np.inf
                floors.append(low.tobytes())
            keep = [c for c in batch if c.startswith("q_")]
            yield batch[keep].assign(floors=floors)

    parts = "q_ids binary, q_dim int, q_data binary, q_norms binary, floors binary"
    seeded = stage(as_query.crossJoin(F.broadcast(longest)).mapInPandas(seed, parts), "topk-seeded")

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            to = []
            for row in batch.to_dict("records"):
                norms, floors = np.frombuffer(row["q_norms"]), np.frombuffer(row["floors"])
                to.append([b << 32 | g for b, g, top in tops if not (norms * top < floors * (1.0 - 1e-9)).all()])
            yield batch.assign(to=to)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                qs = _open(row, "q_")
                for i, ids, scores in _retrieve(qs, _open(row), np.frombuffer(row["floors"]), k):
                    out += [(int(qs[0][i]), int(v), _long(x)) for v, x in zip(ids, scores, strict=True)]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    # Both sides grow with the table, and a query's row is there once for each group that it meets: neither
    # may be broadcast, however small their files look.
    meets = seeded.mapInPandas(route, parts + ", to array<long>").withColumn("to", F.explode("to"))
    place = F.shiftleft(F.col("bucket").cast("long"), 32) + F.floor(F.col("no") / GROUP)
    pairs = meets.join(blocks.select(place.alias("to"), "ids", "dim", "data", "norms").hint("merge"), "to").drop("to")
    found = pairs.mapInPandas(verify, "query_id long, vec_id long, score long")
    # At most k rows per query and block come here; the k best of a query stay.
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score").cast("decimal(20,0)")).alias("s"),
                                                         "vec_id", "score"))), 1, k)
    return (found.groupBy("query_id").agg(best.alias("best"))
            .select("query_id", F.posexplode("best").alias("at", "b"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"),
                    F.col("b.score").alias("score")))


def op7_topk_search(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
