"""Toxicity by non-negative positive-unlabelled learning with linear numpy classifiers."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.llm.common import pick, stage

#: Bounds of the training sample, in documents, dealt by a hash of the id.
MAX_POSITIVE, MAX_UNLABELLED = 6_000, 18_000
#: Hash slots of words and word beginnings, and how many of them the classifiers see.
SLOTS, FEATURES = 1 << 18, 4096
#: A slot is a feature when positives and unlabelled texts differ by so many standard errors,
#: and it is in this share of either (in 4 texts at least); the FALLBACK best where fewer are.
CLEAR, SUPPORT, FALLBACK = 5.0, 0.02, 16
#: Classifiers, each with its own part of the unlabelled texts; scores are averaged.
CLASSIFIERS = 3
STEPS, RATE, DECAY = 300, 0.05, 1e-4
THRESHOLD = 0.3
#: Texts that a task of the filter holds as Python values at once.
ROWS = 512
_EDGE = b".,;:!?\"'()[]{}-_*#"


def slots(word: bytes) -> list[int]:
    """Hash slots of a word: itself and its beginnings of 4, 5 and 6 bytes."""
    w = word.strip(_EDGE)
    parts = [w] + [b"%d:" % n + w[:n] for n in (4, 5, 6) if len(w) >= n]
    return [zlib.crc32(p) % SLOTS for p in parts if p]


class _Known(dict):
    """word -> its slots, kept for the words of a task; emptied when it grows large."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, word):
        if len(self) > 400_000:
            self.clear()
        got = self[word] = self.of(word)
        return got


def _present(text, known: _Known) -> set[int]:
    out: set[int] = set()
    for w in set((text or "").encode().lower().split()):
        if got := known[w]:
            out.update(got)
    return out


def train_nnpu(rows: np.ndarray, cols: np.ndarray, n_pos: int, n_all: int, n_features: int,
               prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier under the non-negative PU risk.

    Documents 0..n_pos-1 are positive, the rest unlabelled; (rows, cols) are
    the features present. Logistic loss: the risk of the positives is
    prior * E_p[l(f)], that of the negatives max(0, E_u[l(-f)] - prior * E_p[l(-f)]);
    where the latter falls below 0 the step goes up its slope instead. Last,
    the bias is set so that the unlabelled texts score ``prior`` on average.
    """
    w, b = np.zeros(n_features), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    share = np.empty(n_all)
    share[:n_pos], share[n_pos:] = 1.0 / max(n_pos, 1), 1.0 / max(n_all - n_pos, 1)
    pos = np.arange(n_all) < n_pos
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    for step in range(1, STEPS + 1):
        f = np.bincount(rows, weights=w[cols], minlength=n_all) + b
        p = 1.0 / (1.0 + np.exp(-np.clip(f, -30, 30)))
        up = np.logaddexp(0, f)  # loss of the answer "negative"
        negative = (up * share)[~pos].sum() - prior * (up * share)[pos].sum()
        if negative >= 0:
            # d/df of prior*l(f) - prior*l(-f) is -prior for positives, sigmoid for the unlabelled.
            g = np.where(pos, -prior, p) * share
        else:
            g = np.where(pos, prior * p, -p) * share
        gw = np.bincount(cols, weights=g[rows], minlength=n_features) + DECAY * w
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        fix = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= fix * m / (np.sqrt(v) + 1e-8)
        b -= fix * mb / (np.sqrt(vb) + 1e-8)
    # The unlabelled texts score the prior on average: with little to learn, that is every score.
    f = (np.bincount(rows, weights=w[cols], minlength=n_all) + b)[~pos]
    lo, hi = -30.0, 30.0
    for _ in range(60):
        shift = (lo + hi) / 2
        if (1.0 / (1.0 + np.exp(-np.clip(f + shift, -30, 30)))).mean() > prior:
            hi = shift
        else:
            lo = shift
    return w, b + (lo + hi) / 2


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(doc_id, text, positive) within the bounds, and the class prior."""
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    slot = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
    known = (pick(labels, "doc_id", "toxic").filter(learn & F.col("toxic").isin(0, 1))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).first()
    n, bad = counts["n"], counts["bad"] or 0
    every = docs.filter("doc_id IS NOT NULL").filter(learn)
    total = every.count()
    part = lambda most, of: int(min(1.0, most / max(of, 1)) * (1 << 30))
    chosen = known.filter((F.col("toxic") == 1) & (slot < part(MAX_POSITIVE, bad))).select("doc_id")
    # Some MAX_POSITIVE ids of 8 bytes, whatever the size of the tables.
    positive = every.join(F.broadcast(chosen), "doc_id", "left_semi").withColumn("positive", F.lit(True))
    unlabelled = every.filter(slot < part(MAX_UNLABELLED, total)).withColumn("positive", F.lit(False))
    # A text counts once on either side, however many copies it has.
    sample = positive.unionByName(unlabelled).withColumn("text", F.coalesce("text", F.lit("")))
    sample = sample.groupBy("positive", "text").agg(F.min("doc_id").alias("doc_id"))
    return stage(sample, "toxic-sample"), (bad / n if n else 0.0)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[int, int], np.ndarray, np.ndarray] | None:
    """(slot -> feature, weights per classifier, biases); None without a toxic label to learn from.

    Confirmed toxic texts are the positives; all others of the learning rows,
    whatever their label, count as unlabelled text. The prior is the toxic
    share of the labelled learning rows. Features are the slots that tell the
    positives from the unlabelled best.
    """
    sample, prior = _sample(docs, labels)

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, SLOTS + 1), dtype=np.int64)  # the last slot counts texts
        known = _Known(slots)
        for batch in batches:
            for text, positive in zip(batch["text"], batch["positive"], strict=True):
                got = list(_present(text, known))
                seen[int(positive)][got] += 1
                seen[int(positive), SLOTS] += 1
        at = np.flatnonzero(seen.sum(axis=0))
        yield pd.DataFrame({"slot": at, "p": seen[1, at], "u": seen[0, at]})

    counts = (sample.select("text", "positive").mapInPandas(tally, "slot long, p long, u long")
              .groupBy("slot").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).orderBy("slot").toPandas())
    whole = counts[counts["slot"] == SLOTS]
    n_p, n_u = (int(whole[c].iloc[0]) if len(whole) else 0 for c in ("p", "u"))
    if not n_p or not n_u:
        return None
    counts = counts[counts["slot"] < SLOTS]
    a, b = counts["p"].to_numpy() / n_p, counts["u"].to_numpy() / n_u
    mean = (counts["p"].to_numpy() + counts["u"].to_numpy()) / (n_p + n_u)
    z = (a - b) / np.sqrt(np.maximum(mean * (1 - mean), 1e-9) * (1 / n_p + 1 / n_u))
    common = (counts["p"].to_numpy() >= max(4, SUPPORT * n_p)) | (counts["u"].to_numpy() >= max(4, SUPPORT * n_u))
    z = np.where(common, np.abs(z), 0.0)
    best = np.lexsort((counts["slot"].to_numpy(), -z))[:FEATURES]
    best = best[:max(int((z >= CLEAR).sum()), FALLBACK)]
    index = {int(s): i for i, s in enumerate(counts["slot"].to_numpy()[best])}

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Known(lambda w: [index[s] for s in slots(w) if s in index])
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "positive": batch["positive"],
                                "at": [sorted(_present(t, known)) for t in batch["text"]]})

    data = (sample.mapInPandas(features, "doc_id long, positive boolean, at array<int>")
            .orderBy("positive", "doc_id").toPandas())
    pos = data[data["positive"]]["at"].tolist()
    rest = data[~data["positive"]]["at"].tolist()
    models = []
    for k in range(CLASSIFIERS):
        texts = pos + rest[k::CLASSIFIERS]
        rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        cols = np.concatenate([np.asarray(t, dtype=np.int64) for t in texts]) if len(rows) else np.zeros(0, np.int64)
        if len(rest[k::CLASSIFIERS]):
            models.append(train_nnpu(rows, cols, len(pos), len(texts), len(index), prior))
    return index, np.array([w for w, _ in models]), np.array([b for _, b in models])


def _scorer(model):
    """A function from texts to scores; without a model every score is 0."""
    if model is None:
        return lambda texts: np.zeros(len(texts))
    index, weights, biases = model
    known = _Known(lambda w: [index[s] for s in slots(w) if s in index])

    def run(texts) -> np.ndarray:
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            at = sorted(_present(text, known))
            f = weights[:, at].sum(axis=1) + biases
            out[i] = (1.0 / (1.0 + np.exp(-np.clip(f, -30, 30)))).mean()
        return out
    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Learns only from rows whose crc32(doc_id as text) mod 4 is not 2; inputs
    of a score are the words of the whole text and nothing else.

    Cases: null and empty texts get the score of no words; a null doc_id is
    scored, not held out and never learned from; repeated rows score alike;
    a document with several labels is toxic if one says so; without a toxic
    label in the learning rows every score is 0; an empty table gives no rows.
    """
    rows = pick(docs, "doc_id", "text")
    model = fit(rows, labels)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _scorer(model)
        for batch in batches:
            yield batch[["doc_id", "held_out"]].assign(score=scorer(batch["text"]))

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return (rows.withColumn("held_out", held)
            .mapInPandas(apply, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is below the threshold."""
    model = fit(pick(docs, "doc_id", "text"), labels)
    names, at = docs.columns, docs.columns.index("text")
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):  # few texts at a time as Python values
                part = batch.slice(lo, ROWS)
                yield part.filter(pa.array(scorer(part.column(at).to_pylist()) < THRESHOLD))

    return rows.mapInArrow(keep, rows.schema).toDF(*names)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
