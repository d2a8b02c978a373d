"""op7 when a bucket holds many groups of blocks, and what its plan sends to the driver."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerostar.llm import topk


@pytest.fixture()
def vectors(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (0.2 + i % 7)]) for i in range(260)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


def _plain(rows, every, k=5):
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    best = {}
    for q in (i for i in whole if i % every == 0):
        best[q] = [(i, -s) for s, i in sorted((-sum(a * b for a, b in zip(whole[q], v)), i)
                                              for i, v in whole.items() if i != q)[:k]]
    return best


def _got(frame):
    found = collections.defaultdict(list)
    for r in frame.orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    return dict(found)


def test_many_groups_of_a_bucket_give_the_same_rows(vectors, monkeypatch):
    rows, frame = vectors
    for name, value in {"BUCKETS": 2, "BLOCK": 8, "QUERY_BLOCK": 4, "GROUP": 2}.items():
        monkeypatch.setattr(topk, name, value, raising=False)
    assert _got(topk.top_k(frame, F.col("vec_id") % 10 == 0)) == _plain(rows, 10)


def test_neither_vectors_nor_queries_are_broadcast(vectors):
    _, frame = vectors
    plan = topk.top_k(frame, F.col("vec_id") % 10 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_table_without_vectors_gives_no_rows(vectors):
    _, frame = vectors
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
