"""Hard negatives against brute force in whole numbers; the tree's bounds; odd rows."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerostar.llm import hard_negatives as hn

KIND = "vec_id long, embedding array<double>, label int, LABEL2 string, tree long, block long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], KIND).withColumnRenamed("LABEL2", "Label")


def valid(rows):
    return [r for r in rows if None not in r[:3] and all(x is not None and math.isfinite(x) for x in r[1])]


def whole(x):
    return [int(v) * 256 if abs(v) >= 2.0**45 else math.floor(v * 256.0) for v in x]


def plain(rows, every):
    rows = [(i, whole(e), label) for i, e, label in valid(rows)]
    out = []
    for a, x, label in rows:
        if a % every:
            continue
        score = [(-max(-2**63, min(2**63 - 1, sum(p * q for p, q in zip(x, e)))), i, k) for i, e, k in rows if i != a]
        positives = sorted(s for s in score if s[2] == label)[:5]
        for s, p, _ in positives:
            fit = sorted((n, i) for n, i, k in score if k != label and 30 * -s <= 100 * -n <= 90 * -s)[:10]
            out += [(a, p, rank, i, -s, -n) for rank, (n, i) in enumerate(fit, 1)]
    return sorted(out)


def vectors(n, seed, groups=6, spread=0.3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, 8))
    at = rng.integers(0, groups, n)
    x = middles[at] + rng.normal(size=(n, 8)) * spread
    x *= rng.choice([0.2, 1.0, 3.0], n)[:, None]
    return [(int(i), [float(v) for v in x[i]], int((at[i] + (rng.random() < 0.3)) % 4)) for i in range(n)]


@pytest.mark.parametrize("seed,spread", [(1, 0.02), (2, 0.5)])
def test_equals_brute_force(spark, monkeypatch, seed, spread):
    monkeypatch.setattr(hn, "BLOCK", 40)
    monkeypatch.setattr(hn, "SPLIT", 3)
    monkeypatch.setattr(hn, "ANCHORS", 9)
    rows = vectors(600, seed, spread=spread)
    got = sorted(map(tuple, hn.mine(frame(spark, rows), F.col("vec_id") % 13 == 0).collect()))
    assert got and got == plain(rows, 13)


def test_odd_rows(spark):
    rows = vectors(60, 3) + [(60, None, 1), (61, [1.0, None], 1), (62, [math.nan, 1.0], 1), (63, [math.inf], 1), (64, [1.0] * 8, None),
                             (None, [1.0] * 8, 1), (65, [], 1), (66, [2.0], 2), (67, [0.0] * 8, 2), (10, [1.0] * 8, 1),
                             (10, [1.0] * 8, 1), (5, [9.0] * 8, 3), (5, [9.0] * 8, 3)]
    got = sorted(map(tuple, hn.mine(frame(spark, rows), F.col("vec_id") % 5 == 0).collect()))
    assert got == plain(rows, 5)
    assert hn.mine(frame(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    assert hn.mine(frame(spark, rows), F.col("vec_id") == -1).count() == 0


def test_products_beyond_doubles(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=4) * 1e5 + 3e5], int(rng.integers(0, 3))) for i in range(80)]
    got = sorted(map(tuple, hn.mine(frame(spark, rows), F.col("vec_id") % 9 == 0).collect()))
    assert got and got == plain(rows, 9)
    # Some too large for 256 times a double: their scores count as the ends of a long, the others stay exact.
    giant = [(i, [1.7e308, 1.0] if i % 3 == 1 else [0.0, 1.0 + i], i % 2) for i in range(12)]
    got = sorted(map(tuple, hn.mine(frame(spark, giant), F.col("vec_id") % 4 == 0).collect()))
    assert got and got == plain(giant, 4)


def test_the_tree_is_a_shortest_one_and_its_bounds_hold():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(30, 5))
    edges = hn.spanning_tree(x)
    assert sorted(n for n, _, _ in edges) == list(range(30))
    # Kruskal's total.
    pairs = sorted((float(np.linalg.norm(x[i] - x[j])), i, j) for i in range(30) for j in range(i))
    group, total = list(range(30)), 0.0
    for d, i, j in pairs:
        if group[i] != group[j]:
            old, total = group[i], total + d
            group = [group[j] if g == old else g for g in group]
    assert sum(e for _, _, e in edges) == pytest.approx(total)


def test_only_overlapping_candidates_are_scored(monkeypatch):
    rng = np.random.default_rng(6)
    x = np.repeat(rng.normal(size=(4, 16)), 25, axis=0) + rng.normal(size=(100, 16)) * 0.002
    row = {"ids": np.arange(100).tobytes(), "labels": (np.arange(100) // 25).tobytes(), "dim": 16, "data": x.tobytes(),
           "norms": np.linalg.norm(np.floor(x * 256), axis=1).tobytes()}
    scored = []
    real = hn._scores
    monkeypatch.setattr(hn, "_scores", lambda a, i, o, at: scored.append(len(at)) or real(a, i, o, at))
    tree = hn.Tree(row | {"wanted": [{"place": i, "positive": 1, "score": 10**6} for i in range(100)]})
    tree.negatives(hn.Rows(row))
    assert sum(scored) < 100 * 100 / 4
