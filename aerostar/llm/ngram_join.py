"""N-gram Jaccard join: universe partition, pigeonhole over segments, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.llm.common import pick, stage, unstage
from aerostar.llm.components import components
from aerostar.llm.words import direct_hashes, gram_hashes, mix, words


class Rule(NamedTuple):
    """Words of a shingle; two sets link when num * union <= den * intersection."""

    shingle: int
    num: int
    den: int


#: The rule of the query.
OP9 = Rule(4, 85, 100)
#: Sizes of a band differ by this factor at most.
BAND = 1.6
#: One segment of a scheme is indexed with its one-deletion neighbourhood.
DELETION_SEGMENTS = 1
#: Share of docs that share a token by chance, for the cost of a segment.
COMMON = 0.05
SKETCH_BITS = 256
#: The sketch of sets that are still open after the first checks: there a narrow one is full of large differences.
FINE_BITS = 2048


def most_apart(total: int, rule: Rule = OP9) -> int:
    """Largest symmetric difference of two linked sets whose sizes add up to ``total``."""
    return total * (rule.den - rule.num) // (rule.den + rule.num)


def _bands() -> tuple[tuple[int, int], ...]:
    out, lo = [], 1
    while lo < 1 << 62:
        out.append((lo, int(lo * BAND)))
        lo = out[-1][1] + 1
    return tuple(out)


#: Size bands (from, to).
BANDS = _bands()


def band_of(n: int) -> int:
    return next(i for i, (_, hi) in enumerate(BANDS) if n <= hi)


def scheme(band: int, rule: Rule = OP9) -> tuple[int, int]:
    """(segments, of them with deletions) of a band: weights 1 and 2 exceed its most differences."""
    need = most_apart(2 * BANDS[band][1], rule) + 1
    weight = need + need // 20 + 1
    return max(weight - DELETION_SEGMENTS, 1), DELETION_SEGMENTS


def segment_of(tokens: np.ndarray, m: int) -> np.ndarray:
    """Segment (0 to m - 1) of each token: its upper 32 bits, scaled; tokens are hashes already."""
    at = ((tokens >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    return at.astype(np.uint16 if m <= 1 << 16 else np.int64)


def signature(tokens: np.ndarray, value: np.ndarray, band: int, need: int,
              rule: Rule = OP9) -> tuple[np.ndarray, np.ndarray]:
    """(keys that probe, the other keys) of a set in the scheme of ``band``.

    ``value`` holds another hash of each token, summed up in each segment.
    Tokens are hashed into segments. Two sets that differ in fewer than
    ``need`` tokens agree on a segment, or differ by one token in a segment
    with deletions, among any segments whose weights (1, with deletions 2)
    reach ``need``: by the pigeonhole principle. The probing segments are the
    cheapest that reach it; small segments, which many sets share by chance,
    cost most.
    """
    m, d = scheme(band, rule)
    at = segment_of(tokens, m)
    order = np.argsort(at, kind="stable")
    at, value = at[order], value[order]
    size = np.bincount(at, minlength=m)
    total = np.zeros(m, dtype=np.uint64)
    filled = np.flatnonzero(size)
    if len(filled):
        starts = np.concatenate([[0], np.cumsum(size[filled])[:-1]])
        total[filled] = np.add.reduceat(value, starts)
    place = np.arange(m, dtype=np.uint64) + np.uint64(band << 40)
    whole = mix(total ^ mix(place, 11), 12)
    cost = COMMON ** np.minimum(size, 60).astype(np.float64)
    weight = np.ones(m, dtype=np.int64)
    weight[:d] = 2
    cost[:d] *= (size[:d] + 1) / COMMON / 2
    rank = np.argsort(cost, kind="stable")
    used = np.zeros(m, dtype=bool)
    reach = np.cumsum(weight[rank])
    used[rank[: int(np.searchsorted(reach, need)) + 1]] = True
    few = at < d
    gaps, owner = value[few], at[few]
    without = mix((total[owner] - gaps) ^ mix(place[owner], 11), 12)
    probe = np.concatenate([whole[used], without[used[owner]]])
    rest = np.concatenate([whole[~used], without[~used[owner]]])
    return probe, rest


def signatures(tokens: np.ndarray, rule: Rule = OP9) -> tuple[np.ndarray, int]:
    """All keys of a set, those that probe first, and how many these are.

    In its own band a set probes for smaller partners and is found by larger
    ones through all its segments; in the next band it only probes.
    """
    n = len(tokens)
    band = band_of(n)
    value = mix(tokens, 7)
    probes, rest = [], []
    if most_apart(2 * BANDS[band][1], rule):
        a, b = signature(tokens, value, band, most_apart(2 * n, rule) + 1, rule)
        probes.append(a)
        rest.append(b)
    largest = n * rule.den // rule.num
    if largest >= BANDS[band + 1][0]:
        a, _ = signature(tokens, value, band + 1, most_apart(n + largest, rule) + 1, rule)
        probes.append(a)
    n_probe = sum(map(len, probes))
    keys = np.concatenate([*probes, *rest]) if probes else np.zeros(0, np.uint64)
    return keys, n_probe


def parities(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Parity sketch of a set as longs: bit i tells whether an odd number of tokens are i modulo ``bits``."""
    odd = np.bincount((tokens % np.uint64(bits)).astype(np.uint16), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _tokens(text, shingle: int) -> np.ndarray:
    """Hashes of the distinct shingles of a text, in order."""
    tokens = np.sort(gram_hashes(direct_hashes(words(text)), shingle))
    return tokens[np.diff(tokens, prepend=~tokens[:1]) != 0]


SET_SCHEMA = ("doc_id long, print long, n long, s1 long, s2 long, k0 long, k1 long, k2 long, k3 long, "
              "n_probe int, keys array<long>")


def _sets(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, keys = [], []
        for text in batch.column(1):
            tokens = _tokens(text.as_py(), rule.shingle)
            with np.errstate(over="ignore"):
                sums = [int(x.sum(dtype=np.uint64)) for x in (tokens, mix(tokens, 22))]
            sketch = parities(tokens, SKETCH_BITS)
            got, n_probe = signatures(tokens, rule)
            rows.append((len(tokens), *np.array(sums, dtype=np.uint64).view(np.int64).tolist(), *sketch.tolist(), n_probe))
            keys.append(got.view(np.int64))
        cols = list(zip(*rows, strict=True)) or [()] * 8
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
        values = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        arrays = [batch.column(0), batch.column(2), *[pa.array(c, pa.int64()) for c in cols[:7]], pa.array(cols[7], pa.int32()),
                  pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "print", "n", "s1", "s2", "k0", "k1", "k2", "k3", "n_probe", "keys"])


FINE_SCHEMA = ", ".join(["node long", "n long", *[f"k{i} long" for i in range(FINE_BITS // 64)]])


def _fine(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Size and fine sketch of the sets of texts (node, text)."""
    for batch in batches:
        sets = [_tokens(text.as_py(), rule.shingle) for text in batch.column(1)]
        sketches = np.array([parities(x, FINE_BITS) for x in sets], dtype=np.int64).reshape(len(sets), FINE_BITS // 64)
        columns = [batch.column(0), pa.array([len(x) for x in sets], pa.int64()), *[pa.array(k) for k in sketches.T.copy()]]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "n", *[f"k{i}" for i in range(FINE_BITS // 64)]])


def _verify(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Links among pairs of texts, by the shingles themselves; a pair of texts at a time."""
    def grams(text) -> frozenset:
        w = words(text)
        return frozenset(zip(*[w[j:] for j in range(rule.shingle)], strict=False)) if len(w) >= rule.shingle else frozenset([tuple(w)] if w else [])

    last = (None, frozenset())
    for batch in batches:
        ok = []
        for a, left, right in zip(batch.column("a").to_pylist(), batch.column("left"), batch.column("right"), strict=True):
            if last[0] != a:
                last = (a, grams(left.as_py()))
            x, y = last[1], grams(right.as_py())
            both = len(x & y)
            ok.append(both > 0 and rule.den * both >= rule.num * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


#: Rounds, while they find links, in which the open candidates are checked against a pivot of each key
#: before all pairs are.
PIVOT_ROUNDS = 5


def _side(df: DataFrame, info: DataFrame, side: str) -> DataFrame:
    """Add to ``df`` the set size and parity sketch of its column ``side`` (a or b)."""
    return df.join(info.select(F.col("node").alias(side),
                               *[F.col(c).alias(f"{c}_{side}") for c in ("n", *_sketch(info))]), side)


def _sketch(info: DataFrame) -> list[str]:
    """The columns k0, k1, ... of a sketch."""
    return [c for c in info.columns if c[0] == "k"]


def _fit(rule: Rule, sketch: list[str]):
    """Whether sets of these sizes and sketches can link: a differing token flips one bit at most."""
    flips = sum(F.bit_count(F.col(f"{k}_a").bitwiseXOR(F.col(f"{k}_b"))) for k in sketch)
    return ((rule.den * F.least("n_a", "n_b") >= rule.num * F.greatest("n_a", "n_b"))
            & (flips <= F.floor((F.col("n_a") + F.col("n_b")) * (rule.den - rule.num) / F.lit(rule.den + rule.num))))


def _links(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The linked ones of ``pairs`` (a, b), verified on the texts."""
    kept = stage(pairs.select("a", "b").distinct(), "ngram-pairs")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    found = stage(kept.join(right, "b").join(left, "a").select("a", "b", "left", "right")
                  .mapInArrow(lambda batches: _verify(batches, rule), "a long, b long"), "ngram-links")
    unstage(kept)
    return found


def _voted(stars: DataFrame, info: DataFrame, rule: Rule, fit_first: bool) -> DataFrame:
    """Of ``stars`` (a, b; one row per shared key), the a with which each b shares most keys.

    ``fit_first``: only among those that sizes and sketches don't rule out; else the choice comes first,
    which spares two joins of all stars.
    """
    def fitting(pairs: DataFrame) -> DataFrame:
        return _side(_side(pairs, info, "a"), info, "b").filter(_fit(rule, _sketch(info)))

    votes = stars.groupBy("a", "b").count()
    best = ((fitting(votes) if fit_first else votes).groupBy("b")
            .agg(F.max(F.struct("count", (-F.col("a")).alias("a"))).alias("best"))
            .select((-F.col("best.a")).alias("a"), "b"))
    return best if fit_first else fitting(best)


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of keys that still bring unconnected sets together, with their ``root``.

    Of keys with the same members, which bring the same pairs together, one stays: they are told by
    the count and two sums of 64-bit hashes of their members.
    """
    tagged = (members.select("key", "node", "probe").join(labels.select("node", "root"), "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    sums = [F.sum(F.xxhash64("node", "probe", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(2)]
    keys = (tagged.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("held"), *sums)
            .filter("lo < hi").groupBy("held", "s0", "s1").agg(F.min("key").alias("key")))
    return stage(tagged.join(stage(keys.select("key"), "ngram-open-keys"), "key"), "ngram-open")


def near_components(docs: DataFrame, rule: Rule = OP9) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_same.

    Rows with the same shingle set form a class (n_same: its rows): sets are
    the same when their sizes and two 64-bit sums over hashes of their
    shingles are; this is the one place where hashes alone decide. Each class
    is a node, also if its rows share their ids with rows of other classes.
    Each set is cut into hashed segments by the scheme of its size band; sets
    that share a segment key (or a one-deletion key) are candidates. First
    each set is checked against one node of each of its keys, the one with
    which it shares most, then, where a key still holds unconnected sets,
    against other pivots. In the end every pair of candidates that isn't
    connected yet is checked, so no link between components is lost, and a
    dense group costs a few checks per member, not one per pair. The sets that
    are still open get a finer sketch first, which rules out nearly all pairs
    that don't link.

    Cases: null or empty texts have 0 shingles and are components of their
    own; a null doc_id gets a null component and links nothing; rows that
    share an id are one document, linked by whatever either row links to; an
    empty table gives no rows.
    """
    docs = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text")).withColumn(
        "print", F.xxhash64("text"))
    found = docs.select("doc_id", "text", "print").mapInArrow(lambda batches: _sets(batches, rule), SET_SCHEMA)
    sets = stage(found.withColumn("row", F.monotonically_increasing_id()), "ngram-sets")
    rows = stage(sets.select("doc_id", "n", "s1", "s2", "row"), "ngram-rows")
    named = rows.filter("doc_id IS NOT NULL AND n > 0")
    # A class is known by the row that stands for it: of the smallest id.
    classes = stage(named.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.min_by("row", "doc_id").alias("node"),
                                                              F.count(F.lit(1)).alias("n_same")), "ngram-classes")
    # Written once: the keys are read twice below, and the sets can go before.
    heads = stage(sets.withColumnRenamed("row", "node").join(classes.select("node"), "node", "left_semi"), "ngram-heads")
    unstage(sets)
    info = stage(heads.select("node", "doc_id", "print", "n", "k0", "k1", "k2", "k3"), "ngram-info")

    keys = (heads.select("node", "n_probe", F.posexplode("keys").alias("pos", "key"))
            .select("key", "node", (F.col("pos") < F.col("n_probe")).alias("probe")))
    # Nearly every key is held once, so the rows of this aggregate carry two small numbers only.
    shared = stage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.max("probe").alias("probed"))
                   .filter("held > 1 AND probed").select("key"), "ngram-shared")
    members = stage(keys.join(shared, "key"), "ngram-members")
    unstage(heads, shared)
    # The texts of all candidates are taken out once, by a merge join at every size; rows that repeat
    # both id and text give one.
    wanted = info.select("node", "doc_id", "print").join(members.select("node").distinct(), "node", "left_semi")
    texts = stage(docs.join(wanted.hint("merge"), ["doc_id", "print"]).groupBy("doc_id", "print", "node")
                  .agg(F.first("text").alias("text")).select("node", "text"), "ngram-texts")

    # Rows that share an id but not a set.
    of_id = named.join(classes, ["n", "s1", "s2"]).select("doc_id", "node")
    twins = of_id.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("top")).filter("a < top")
    twins = stage(of_id.join(twins.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b")), "ngram-twins")

    heads = members.groupBy("key").agg(F.min("node").alias("a"))
    stars = members.join(heads, "key").filter("node <> a").select("a", F.col("node").alias("b"))
    links = _links(_voted(stars, info, rule, False), texts, rule).unionByName(twins)
    labels = components(links)
    left = _open(members, labels)
    unstage(members)
    fine = stage(texts.join(left.select("node").distinct(), "node", "left_semi").select("node", "text")
                 .mapInArrow(lambda batches: _fine(batches, rule), FINE_SCHEMA), "ngram-fine")
    for turn in range(PIVOT_ROUNDS):
        # Another pivot of each key: the least by a hash of the round.
        by = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "root")
        pivots = stage(left.groupBy("key").agg(F.min(by).alias("p")).select(
            "key", F.col("p.node").alias("a"), F.col("p.root").alias("ra")), "ngram-pivots")
        stars = left.join(pivots, "key").filter("ra <> root").select("a", F.col("node").alias("b"))
        found = _links(_voted(stars, fine, rule, True), texts, rule)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        labels = components(links)
        left = _open(left, labels)
    # What is left is checked pair by pair, except what sizes and sketches rule out.
    side = lambda name: _side(left.select("key", F.col("node").alias(name), F.col("probe").alias(f"p_{name}"),
                                          F.col("root").alias(f"r_{name}")), fine, name)
    x, y = side("a"), side("b")
    cross = x.join(y, (x["key"] == y["key"]) & (x["a"] < y["b"]) & (x["r_a"] != y["r_b"])
                   & (x["p_a"] | y["p_b"]) & _fit(rule, _sketch(fine)))
    found = _links(cross.select("a", "b"), texts, rule)
    if not found.isEmpty():
        labels = components(links.unionByName(found))

    # A component is named by the smallest id of its classes.
    placed = classes.join(labels.select("node", "root"), "node", "left")
    least = placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("rep").alias("least"))
    many = placed.join(least, "root", "left").select("n", "s1", "s2", "rep", "n_same", "least")
    many = stage(many.filter("n_same > 1 OR least IS NOT NULL"), "ngram-merged")
    out = rows.join(many, ["n", "s1", "s2"], "left")
    known = F.col("doc_id").isNotNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(known, F.coalesce("least", "rep", "doc_id")).alias("component_id"),
                      F.coalesce("n_same", F.lit(1)).cast("long").alias("n_same"))


def one_of_each(docs: DataFrame, rule: Rule = OP9) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Rows without an id or without words stay. Rows that repeat an id stay or go together.
    """
    found = near_components(docs, rule)
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key = F.col(f"c{names.index('doc_id')}")
    gone = stage(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "ngram-gone")
    return rows.join(gone.hint("merge"), key == gone["_gone"], "left_anti").toDF(*names)


def op9_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
