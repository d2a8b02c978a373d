"""Hard-negative mining: a spanning tree over the anchors bounds their scores, what may matter is scored exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostar.llm.common import pick, stage, table

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 30, 90
#: Most anchors of a tree, candidates of a block, and blocks that one task goes through for a tree.
ANCHORS, BLOCK, SPLIT = 1024, 512, 16
EXACT = 2.0**53
VECTOR = "vec_id long, label long, norm double, data binary"
BLOCKS = "block long, lo long, hi long, top double, dim int, ids binary, labels binary, norms binary, data binary"
LONG = np.int64


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components as doubles, and the length of the vector of their integer values."""
    for batch in batches:
        lists = batch.column("embedding")
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(LONG)
        flat = lists.flatten().to_numpy(zero_copy_only=False)  # a null becomes not a number
        keep, norms, data = [], [], []
        for i in range(len(lists)):
            x = flat[ends[i]:ends[i + 1]]
            if np.isfinite(x).all():
                with np.errstate(over="ignore"):
                    top = np.abs(np.floor(x * 256.0)).max(initial=0.0)
                    norms.append(float(np.linalg.norm(np.floor(x * 256.0) / top) * top) if 0 < top < np.inf else float(top))
                keep.append(i)
                data.append(x.astype(np.float64).tobytes())
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(at), batch.column("label").take(at), pa.array(norms, pa.float64()),
             pa.array(data, pa.binary())], ["vec_id", "label", "norm", "data"])


def _packed(limit: int):
    """Consecutive vectors of a task in blocks of at most ``limit``."""
    def block(rows, no):
        ids, labels, norms, data = zip(*rows, strict=True)
        dim = max(map(len, data)) // 8
        flat = np.zeros((len(rows), dim))
        for to, x in zip(flat, data, strict=True):
            to[:len(x) // 8] = np.frombuffer(x)
        return ((TaskContext.get().partitionId() << 32) + no, min(labels), max(labels), max(norms), dim,
                np.array(ids, LONG).tobytes(), np.array(labels, LONG).tobytes(), np.array(norms).tobytes(), flat.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, no = [], 0

        def out(some):
            return pa.RecordBatch.from_pylist([dict(zip(names, block(some, no), strict=True))], schema=kind)

        names = [c.split()[0] for c in BLOCKS.split(", ")]
        kinds = {"long": pa.int64(), "double": pa.float64(), "int": pa.int32(), "binary": pa.binary()}
        kind = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in BLOCKS.split(", ")])
        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(rows) >= limit:
                yield out(rows[:limit])
                rows, no = rows[limit:], no + 1
        if rows:
            yield out(rows)
    return run


def _blocks(vectors: DataFrame, limit: int, label: str) -> DataFrame:
    order = ["label", F.col("norm").desc(), "vec_id"]
    return stage(vectors.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packed(limit), BLOCKS), label)


class Rows:
    """The vectors of a block."""

    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], LONG), np.frombuffer(row["labels"], LONG)
        self.norms = np.frombuffer(row["norms"])
        self.given = np.frombuffer(row["data"]).reshape(len(self.ids), row["dim"])
        with np.errstate(over="ignore"):
            self.x = np.floor(self.given * 256.0)

    def whole(self, at) -> np.ndarray:
        """Components as Python integers, for products that doubles don't hold."""
        value = lambda v: int(v) * 256 if abs(v) >= 2.0**45 else math.floor(v * 256.0)
        return np.array([[value(v) for v in r] for r in self.given[at].tolist()], dtype=object).reshape(len(at), -1)


def _scores(anchors: Rows, i: int, others: Rows, at: np.ndarray) -> np.ndarray:
    """Exact inner products of anchor ``i``."""
    d = min(anchors.x.shape[1], others.x.shape[1])
    if not len(at):
        return np.zeros(0, LONG)
    if anchors.norms[i] * others.norms[at].max() < EXACT:
        return (others.x[at, :d] @ anchors.x[i, :d]).astype(LONG)
    return others.whole(at)[:, :d] @ anchors.whole([i])[0, :d]


def spanning_tree(x: np.ndarray) -> list[tuple[int, int, float]]:
    """(node, parent, distance), parents first, of a shortest tree over the rows of ``x``; the root is its own parent."""
    with np.errstate(over="ignore", invalid="ignore"):
        middle = int(np.argmin(np.nan_to_num(np.square(x - x.mean(axis=0)).sum(axis=1), nan=np.inf)))
        near, parent, left = np.full(len(x), np.inf), np.full(len(x), middle), np.ones(len(x), bool)
        out, node = [(middle, middle, 0.0)], middle
        left[middle] = False
        while left.any():
            far = np.nan_to_num(np.sqrt(np.square(x - x[node]).sum(axis=1)), nan=np.inf)
            closer = left & (far < near)
            near[closer], parent[closer] = far[closer], node
            node = int(np.flatnonzero(left)[np.argmin(near[left])])
            left[node] = False
            # A little longer than computed, so rounding can't make a bound too narrow.
            out.append((node, int(parent[node]), float(near[node]) * (1 + 1e-9)))
    return out


def _float(value: float) -> float:
    """The nearest double, beyond them an infinity."""
    try:
        return float(value)
    except OverflowError:
        return math.inf if value > 0 else -math.inf


def _ends(exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of scores that are known; a score beyond doubles is bounded by nothing."""
    if exact.dtype != object:
        return exact.astype(np.float64), exact.astype(np.float64)
    near = np.array([_float(v) for v in exact])
    return np.where(np.isinf(near), -np.inf, near), np.where(np.isinf(near), np.inf, near)


class Best:
    """The ``k`` highest (score, id) met so far, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.rows, self.floor = k, [], -math.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.floor) if self.rows and self.floor > -math.inf else np.arange(len(scores))
        if len(at) > 4 * self.k and scores.dtype != object:
            kth = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
            at = at[scores[at] >= kth]
        if len(at):
            new = [(-int(scores[i]), int(ids[i])) for i in at]
            self.rows = sorted(self.rows + new)[:self.k]
            if len(self.rows) == self.k:
                self.floor = -self.rows[-1][0]


class Tree:
    """The anchors of a block, their spanning tree, and what each has found so far."""

    def __init__(self, row: dict):
        self.rows = Rows(row)
        self.edges = spanning_tree(self.rows.x)
        self.wanted = {}
        for w in row.get("wanted") or ():
            self.wanted.setdefault(w["place"], []).append((w["positive"], w["score"]))
        self.best: dict[tuple[int, int], Best] = {}

    def _bounds(self, others: Rows):
        """(anchor, lower, upper) in tree order; who rescores writes the exact values into both."""
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for node, parent, edge in self.edges:
            if node == parent:
                bounds[node] = _ends(_scores(self.rows, node, others, np.arange(len(others.ids))))
            else:
                with np.errstate(invalid="ignore", over="ignore"):
                    # One more than the distance allows, for the rounding of doubles.
                    move = edge * others.norms * (1 + 1e-9) + 1.0
                    low, high = bounds[parent][0] - move, bounds[parent][1] + move
                bounds[node] = np.nan_to_num(low, nan=-np.inf, neginf=-np.inf, posinf=np.inf), np.nan_to_num(
                    high, nan=np.inf, neginf=-np.inf, posinf=np.inf)
            yield node, *bounds[node]

    def _rescore(self, node: int, others: Rows, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        exact = _scores(self.rows, node, others, at)
        low[at], high[at] = _ends(exact)
        return exact

    def positives(self, others: Rows) -> None:
        """Rows of the anchor's label; only those whose upper bound reaches its floor are scored."""
        for node, low, high in self._bounds(others):
            best = self.best.setdefault((node, 0), Best(POSITIVES))
            at = np.flatnonzero((others.labels == self.rows.labels[node]) & (others.ids != self.rows.ids[node])
                                & (high >= _float(best.floor)))
            if len(at):
                best.add(self._rescore(node, others, at, low, high), others.ids[at])

    def negatives(self, others: Rows) -> None:
        """Rows of other labels; only those whose bounds overlap the window of one of its positives are scored."""
        for node, low, high in self._bounds(others):
            if node not in self.wanted:
                continue
            windows = []
            for positive, score in self.wanted[node]:
                best = self.best.setdefault((node, positive), Best(NEGATIVES))
                windows.append((score, best, max(_float(LEAST * score // 100), _float(best.floor)), _float(MOST * score // 100)))
            may = np.zeros(len(others.ids), bool)
            for _, _, least, most in windows:
                if least <= most:
                    may |= (high >= least - 1) & (low <= most + 2)
            at = np.flatnonzero(may & (others.labels != self.rows.labels[node]) & (others.ids != self.rows.ids[node]))
            if not len(at):
                continue
            exact = self._rescore(node, others, at, low, high)
            for score, best, _, _ in windows:
                fit = np.flatnonzero((LEAST * score <= 100 * exact) & (100 * exact <= MOST * score))
                best.add(exact[fit], others.ids[at][fit])

    def found(self) -> Iterator[tuple[int, int, int, int, int]]:
        for (node, positive), best in self.best.items():
            for minus, other in best.rows:
                yield node, int(self.rows.ids[node]), positive, other, max(-2**63, min(2**63 - 1, -minus))


FOUND = "tree long, place int, anchor_id long, positive int, other long, score long"


def _search(step: str):
    """Rows come by (tree, split): the anchors first, then the candidates' blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, key = None, None

        def flush():
            rows = [(key[0], *r) for r in tree.found()] if tree else []
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                              [c.split()[0] for c in FOUND.split(", ")])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if row["no"] < 0:
                    yield flush()
                    tree, key = Tree(row), (row["tree"], row["split"])
                else:
                    getattr(tree, step)(Rows(row))
        yield flush()
    return run


def _met(trees: DataFrame, blocks: DataFrame, splits: int, fits: Column, step: str, k: int) -> DataFrame:
    """The ``k`` best of each (tree, place, positive): every tree meets the blocks that fit, SPLIT of them a task."""
    to_splits = F.explode(F.sequence(F.lit(0), F.lit(splits - 1)))
    short = [F.col(c).alias(f"t_{c}") for c in ("lo", "hi", "top", "least")]
    asked = trees.select(F.col("block").alias("tree"), *short, to_splits.alias("split"))
    routes = asked.join(blocks.select("block", "split", "lo", "hi", "top"), "split").filter(fits).select("tree", "split", "block")
    data = ["dim", "ids", "labels", "norms", "data"]
    wanted = trees.schema["wanted"].dataType
    theirs = routes.join(blocks.select("block", *data), "block").select(
        "tree", "split", F.col("block").alias("no"), *data, F.lit(None).cast(wanted).alias("wanted"))
    own = (trees.select(F.col("block").alias("tree"), to_splits.alias("split"), F.lit(-1).cast("long").alias("no"), *data, "wanted")
           .join(routes.select("tree", "split").distinct(), ["tree", "split"], "left_semi"))
    met = own.unionByName(theirs).repartition("tree", "split").sortWithinPartitions("tree", "split", "no")
    best = Window.partitionBy("tree", "place", "positive").orderBy(F.desc("score"), "other")
    return (met.mapInArrow(_search(step), FOUND).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k))


def mine(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for ``rows`` (vec_id, embedding, label).

    Anchors lie in blocks of at most ANCHORS; a shortest spanning tree over
    each gives an order in which every anchor has a parent. What a candidate
    scores with the parent, plus or minus the edge's length times the
    candidate's, bounds its score with the child. Only candidates whose bounds
    reach the weakest positive so far, or overlap the window of one of the
    positives, are scored, exactly. A task holds one tree and one block of
    candidates at a time.

    Cases: rows take no part if their id, label or vector is null or a
    component is null or not finite; of vectors of unlike lengths the missing
    components count as 0, an empty vector scores 0; ties go to the smaller
    id; rows that share the anchor's id are its own, neither positives nor
    negatives; repeated rows are candidates and anchors each; scores beyond a long count as its ends;
    without anchors, positives or fitting rows there are no rows.
    """
    base = (pick(rows, "vec_id", "embedding", "label").filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
            .select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")))
    vectors = stage(base.mapInArrow(_vectors, VECTOR), "negatives-vectors")
    trees = _blocks(vectors.filter(is_anchor), ANCHORS, "negatives-anchors")
    blocks = _blocks(vectors, BLOCK, "negatives-blocks")
    splits = max(1, -(-blocks.count() // SPLIT))
    blocks = blocks.withColumn("split", F.pmod(F.xxhash64("block"), F.lit(splits)).cast("int"))

    kind = "array<struct<place:int,positive:int,score:bigint>>"
    plain = trees.withColumn("wanted", F.lit(None).cast(kind)).withColumn("least", F.lit(0.0))
    alike = (F.col("t_lo") <= F.col("hi")) & (F.col("lo") <= F.col("t_hi"))
    positives = stage(_met(plain, blocks, splits, alike, "positives", POSITIVES).select(
        "tree", "place", "anchor_id", F.col("rank").alias("positive"), F.col("other").alias("positive_id"),
        F.col("score").alias("positive_score")), "negatives-positives")

    # A tree's windows: POSITIVES for each of its anchors at most.
    windows = positives.groupBy(F.col("tree").alias("block")).agg(
        F.collect_list(F.struct("place", "positive", F.col("positive_score").alias("score"))).alias("wanted"),
        (F.min("positive_score") * (LEAST / 100)).alias("least"))
    aware = stage(trees.join(windows, "block"), "negatives-windows")
    # Other labels, and lengths that reach the lowest window; a window of a score below 0 is empty.
    reach = F.col("t_top") * F.col("top") * (1 + 1e-9) + 1 >= F.greatest(F.col("t_least"), F.lit(0.0))
    differ = ~((F.col("t_lo") == F.col("t_hi")) & (F.col("lo") == F.col("hi")) & (F.col("lo") == F.col("t_lo")))
    found = _met(aware, blocks, splits, reach & differ, "negatives", NEGATIVES)
    return found.join(positives, ["tree", "place", "anchor_id", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return mine(pick(rows, "vec_id", "embedding", "label").withColumn("label", label), F.col("vec_id") % ANCHOR_EVERY == 0)


SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e, row_number() OVER () AS row
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.row, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
  QUALIFY place <= {POSITIVES}),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.row, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON p.row = n.row AND NOT n.same
    AND {LEAST} * p.score <= 100 * n.score AND 100 * n.score <= {MOST} * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= {NEGATIVES}
"""
