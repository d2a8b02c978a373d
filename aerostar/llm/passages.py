"""Substring dedup: shared k-mer seeds, collinear chains, aligned fuzzy passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostar.llm.common import pick, stage, unstage
from aerostar.llm.words import direct_hashes, gram_hashes, mix, words
from aerostar.operators.keys import assign_keys

#: Words of a seed; one seed is taken from each window of so many positions.
SEED, WINDOW = 6, 10
#: Words that a passage has at least, and the share of them that the alignment matches.
MIN_WORDS, IDENTITY = 50, 0.8
#: Words between neighbours of a chain, and between the pieces of a passage, at most.
MAX_GAP = 32
#: Score of an anchor and cost of a word of gap: a gap of MAX_GAP words costs an anchor.
GAIN, COST = float(SEED), SEED / MAX_GAP
#: An extension ends when its mismatches exceed its matches by this from the best point.
DROP = 4
#: Borders of cut-out source text, in words.
GRID = 64

SEED_SCHEMA = "doc_id long, seeds array<long>, places array<int>"
PIECE = "doc_id long, xs array<int>, ys array<int>, source_id long"


def seeds_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seed hashes, places) of a text given by its word hashes: the minima of all windows."""
    if len(h) < SEED:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g = gram_hashes(h, SEED)
    order = mix(g, 31)
    width = min(WINDOW, len(g))
    view = np.lib.stride_tricks.sliding_window_view(order, width)
    at = np.unique(view.argmin(axis=1) + np.arange(len(view)))
    return g[at], at


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seeds, places = [], []
        for text in batch.column(1):
            s, p = seeds_of(direct_hashes(words(text.as_py())))
            # A seed's first place in its text is marked by its sign: ~p for the others.
            first = np.zeros(len(s), dtype=bool)
            first[np.unique(s, return_index=True)[1]] = True
            seeds.append(s.view(np.int64))
            places.append(np.where(first, p, ~p).astype(np.int32))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in seeds])]).astype(np.int32), pa.int32())
        empty = [np.zeros(0, np.int64)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0),
             pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(seeds or empty), pa.int64())),
             pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(places or empty).astype(np.int32), pa.int32()))],
            names=["doc_id", "seeds", "places"])


def chain(xs: np.ndarray, ys: np.ndarray) -> list[list[int]]:
    """Collinear chains of anchors (xs ascending): places of the anchors of each.

    The best chain that ends in an anchor adds GAIN to the best earlier one
    with smaller x and y, less COST per word of gap (mean of both sides).
    The cost is linear, so the best predecessor is a prefix maximum over y,
    kept in a Fenwick tree.
    """
    n = len(xs)
    if n == 1:
        return [[0]]
    dx, dy = np.diff(xs), np.diff(ys)
    if (dx > 0).all() and (dy > 0).all() and (np.maximum(dx, dy) <= MAX_GAP).all():
        return [list(range(n))]  # in order and close: every step gains
    level = (np.unique(ys, return_inverse=True)[1] + 1).tolist()
    xs, ys, size = xs.tolist(), ys.tolist(), max(level)
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (size + 1)
    score, before = [0.0] * n, [-1] * n
    waiting: list[int] = []
    for i in range(n):
        if waiting and xs[waiting[0]] < xs[i]:
            for j in waiting:
                item, at = (score[j] + COST * (xs[j] + ys[j]) / 2, j), level[j]
                while at <= size:
                    if tree[at] < item:
                        tree[at] = item
                    at += at & -at
            waiting = []
        top, at = (-np.inf, -1), level[i] - 1
        while at > 0:
            if tree[at] > top:
                top = tree[at]
            at -= at & -at
        gain = top[0] - COST * (xs[i] + ys[i]) / 2
        score[i], before[i] = (GAIN + gain, top[1]) if gain > 0 else (GAIN, -1)
        waiting.append(i)
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = before[i]
        if path:
            path.reverse()
            part = path[:1]
            for p, q in zip(path, path[1:], strict=False):
                if max(xs[q] - xs[p], ys[q] - ys[p]) > MAX_GAP:
                    out.append(part)
                    part = []
                part.append(q)
            out.append(part)
    return out


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, hits) to a row per chain.

    All of them are aligned: a lone anchor can lie in a passage whose other
    seeds were all changed, and only the texts tell.
    """
    for batch in batches:
        hits = batch.column(1)
        offsets = hits.offsets.to_numpy()
        fields = [hits.values.field(i).to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.int64) for i in range(3)]
        doc = np.repeat(np.arange(len(batch)), np.diff(offsets))
        order = np.lexsort((fields[2], fields[1], fields[0], doc))
        doc, source, x, y = doc[order], *(f[order] for f in fields)
        # Groups of a document and a source; those in order and close are one chain each.
        same = (np.diff(doc) == 0) & (np.diff(source) == 0)
        dx, dy = np.diff(x), np.diff(y)
        plain = (dx > 0) & (dy > 0) & (np.maximum(dx, dy) <= MAX_GAP)
        starts = np.concatenate([np.zeros(min(1, len(x)), np.int64), np.flatnonzero(~same) + 1])
        ends = np.append(starts[1:], len(x))
        odd = np.unique(np.cumsum(~same)[same & ~plain])
        at, sizes, done = [], [], 0
        for g in [*odd.tolist(), len(starts)]:
            if g > done:
                at.append(np.arange(starts[done], ends[g - 1]))
                sizes.append(ends[done:g] - starts[done:g])
            if g < len(starts):
                paths = chain(x[starts[g]:ends[g]], y[starts[g]:ends[g]])
                at.append(starts[g] + np.array([i for path in paths for i in path]))
                sizes.append(np.array([len(path) for path in paths]))
            done = g + 1
        at = np.concatenate(at) if at else np.zeros(0, np.int64)
        sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        first = at[bounds[:-1]]
        lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v[at].astype(np.int32), pa.int32())) for v in (x, y)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(doc[first], pa.int64())), *lists, pa.array(source[first], pa.int64())],
            names=["doc_id", "xs", "ys", "source_id"])


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (doc_id, text, spans) to rows (doc_id, lo, hi, part): the words lo..hi-1."""
    for batch in batches:
        out = []
        for doc_id, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
            w = words(text)
            out += [(doc_id, s["lo"], s["hi"], b" ".join(w[s["lo"]:s["hi"]])) for s in spans]
        yield pd.DataFrame(out, columns=["doc_id", "lo", "hi", "part"])


def _common(a: list[bytes], b: list[bytes]) -> int:
    """Words matched by the best alignment of two gaps."""
    if len(a) == len(b):
        same = sum(x == y for x, y in zip(a, b, strict=True))
        if 2 * same >= len(a):
            return same
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def _extend(a: list[bytes], b: list[bytes]) -> tuple[int, int]:
    """(words, matches) by which two texts go on alike, word by word, mismatches allowed."""
    best = (0, 0)
    score = top = same = 0
    for i, (x, y) in enumerate(zip(a, b, strict=False), 1):
        if x == y:
            score, same = score + 1, same + 1
            if score >= top:
                top, best = score, (i, same)
        else:
            score -= 1
            if top - score >= DROP:
                break
    return best


def align(a: list[bytes], b: list[bytes], xs, ys) -> tuple[int, int, int, int, int]:
    """(from, to) in a and in b, and the words matched, of a chain of anchors given by their places."""
    matched = SEED
    for i in range(1, len(xs)):
        dx, dy = xs[i] - xs[i - 1], ys[i] - ys[i - 1]
        if dx == dy and dx <= SEED:
            matched += dx
        elif min(dx, dy) <= SEED:
            matched += min(dx, dy)
        else:
            matched += SEED + _common(a[xs[i - 1] + SEED:xs[i]], b[ys[i - 1] + SEED:ys[i]])
    left, more = _extend(a[:xs[0]][::-1], b[:ys[0]][::-1])
    right, also = _extend(a[xs[-1] + SEED:], b[ys[-1] + SEED:])
    return xs[0] - left, xs[-1] + SEED + right, ys[0] - left, ys[-1] + SEED + right, matched + more + also


def stretches(same: np.ndarray, size: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Longest runs of cells of which IDENTITY is matched, in order: (from, to) of each.

    A cell has ``size`` words, ``same`` of them matched. The longest run is
    taken, then those left and right of it; each begins and ends with a
    matched cell and has ``least`` words or more.
    """
    score = np.concatenate([[0], np.cumsum(100 * same - round(100 * IDENTITY) * size)])
    words_to = np.concatenate([[0], np.cumsum(size)])
    hits = np.flatnonzero(same)
    out, todo = [], [(0, len(same))]
    while todo:
        lo, hi = todo.pop()
        inside = hits[np.searchsorted(hits, lo):np.searchsorted(hits, hi)]
        if not len(inside):
            continue
        lo, hi = int(inside[0]), int(inside[-1]) + 1
        if words_to[hi] - words_to[lo] < least:
            continue
        # The farthest end whose score is not below the start's.
        part = score[lo:hi + 1]
        ends = len(part) - 1 - np.searchsorted(np.maximum.accumulate(part[::-1]), part)
        reach = words_to[lo + ends] - words_to[lo:hi + 1]
        start = int(reach.argmax())
        i, j = lo + start, lo + int(ends[start])
        if words_to[j] - words_to[i] < least:
            continue
        todo += [(lo, i), (j, hi)]
        inside = hits[np.searchsorted(hits, i):np.searchsorted(hits, j)]
        i, j = int(inside[0]), int(inside[-1]) + 1
        if words_to[j] - words_to[i] >= least:
            out.append((i, j))
    return sorted(out)


def _pairs(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Places of the words that the best alignment of two gaps matches, as many as _common counts."""
    if len(a) == len(b):
        out = [(i, i) for i, (x, y) in enumerate(zip(a, b, strict=True)) if x == y]
        if 2 * len(out) >= len(a):
            return out
    rows = [[0] * (len(b) + 1)]
    for x in a:
        above, row = rows[-1], [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
        rows.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif rows[i - 1][j] >= rows[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def pieces(a: list[bytes], b: list[bytes], xs, ys) -> list[tuple[int, int, int, int, int]]:
    """The alignment of a chain as align gives it, or its stretches that agree where the whole doesn't."""
    x0, x1, y0, y1, same = align(a, b, xs, ys)
    if same >= IDENTITY * (x1 - x0):
        return [(x0, x1, y0, y1, same)]
    at = np.full(x1 - x0, -1)

    def put(x: int, y: int, n: int) -> None:
        at[x - x0:x - x0 + n] = np.arange(y, y + n)

    def side(x: int, y: int, n: int) -> None:
        for k in range(n):
            if a[x + k] == b[y + k]:
                at[x + k - x0] = y + k

    side(x0, y0, xs[0] - x0)
    put(xs[0], ys[0], SEED)
    for i in range(1, len(xs)):
        near = min(xs[i] - xs[i - 1], ys[i] - ys[i - 1])
        if near > SEED:
            x, y = xs[i - 1] + SEED, ys[i - 1] + SEED
            for p, q in _pairs(a[x:xs[i]], b[y:ys[i]]):
                at[x + p - x0] = y + q
        near = min(near, SEED)
        put(xs[i] + SEED - near, ys[i] + SEED - near, near)
    side(xs[-1] + SEED, ys[-1] + SEED, x1 - xs[-1] - SEED)
    hit = (at >= 0).astype(np.int64)
    return [(x0 + i, x0 + j, int(at[i]), int(at[j - 1]) + 1, int(hit[i:j].sum()))
            for i, j in stretches(hit, np.ones_like(hit), SEED)]


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "x0", "x1", "source_id", "y0", "y1", "same"]
    told, there = None, []
    for batch in batches:
        col = {n: batch.column(n) for n in batch.schema.names}
        out, row = [], []
        for i in range(len(batch)):
            # Rows come by the source's part, so its words are split once for a run of them.
            part = col["there"][i].as_py()
            if part != told:
                told, there = part, part.split()
            x_lo, y_lo = col["x_lo"][i].as_py(), col["y_lo"][i].as_py()
            for x0, x1, y0, y1, same in pieces(col["here"][i].as_py().split(), there,
                                               [x - x_lo for x in col["xs"][i].as_py()],
                                               [y - y_lo for y in col["ys"][i].as_py()]):
                out.append((x0 + x_lo, x1 + x_lo, y0 + y_lo, y1 + y_lo, same))
                row.append(i)
        row = pa.array(row, pa.int64())
        x0, x1, y0, y1, same = (pa.array(c, pa.int32()) for c in (zip(*out, strict=True) if out else [()] * 5))
        yield pa.RecordBatch.from_arrays([col["doc_id"].take(row), x0, x1, col["source_id"].take(row), y0, y1, same],
                                         names=names)


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["doc_id", "start", "end", "matched", "source_id", "source_start", "source_end", "source_ids"]
    for batch in batches:
        out = []
        for doc_id, found_here in zip(batch["doc_id"], batch["pieces"], strict=True):
            group, end = [], None

            def told(doc_id, some, lo, hi, same):
                main = max(some, key=lambda p: (p["same"], -p["source_id"], -p["x0"]))
                out.append((doc_id, lo, hi, same, main["source_id"], main["y0"], main["y1"],
                            sorted({int(p["source_id"]) for p in some})))

            def close(doc_id, group):
                # Cells: the words between the pieces, and what each piece adds.
                same, size, upto = [], [], group[0]["x0"]
                for p in group:
                    fresh = max(0, p["x1"] - max(p["x0"], upto))
                    same += [0, min(p["same"], fresh)]
                    size += [max(0, p["x0"] - upto), fresh]
                    upto = max(upto, p["x1"])
                same, size = np.array(same), np.array(size)
                start, found = group[0]["x0"], [(0, len(same))]
                if same.sum() < IDENTITY * size.sum():
                    found = stretches(same, size, MIN_WORDS)
                ends = start + np.concatenate([[0], np.cumsum(size)])
                for i, j in found:
                    lo, hi = int(ends[i]), int(ends[j])
                    if hi - lo >= MIN_WORDS:
                        told(doc_id, [p for p in group if p["x0"] < hi and p["x1"] > lo], lo, hi, int(same[i:j].sum()))

            for p in sorted((r.asDict() if hasattr(r, "asDict") else r for r in found_here),
                            key=lambda p: (p["x0"], -p["x1"], p["source_id"], p["y0"])):
                if group and p["x0"] - end > (1 - IDENTITY) * MAX_GAP:
                    close(doc_id, group)
                    group, end = [], None
                group.append(p)
                end = p["x1"] if end is None else max(end, p["x1"])
            if group:
                close(doc_id, group)
        yield pd.DataFrame(out, columns=names)


def _texts(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(node, doc_id, text_no, text) of each different text of an id, and the first three of them
    where ids repeat, else None. Nodes ascend by doc_id, then by text_no (from 0, by the text's hash)."""
    docs = pick(docs, "doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    if docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return docs.select(F.col("doc_id").alias("node"), "doc_id", F.lit(0).alias("text_no"), "text"), None
    # By the text itself, so that texts of one hash stay apart.
    texts = docs.withColumn("print", F.xxhash64("text")).distinct()
    numbered = assign_keys(texts, "node", ["doc_id", "print", "text"])
    own = Window.partitionBy("doc_id").orderBy("node")
    texts = stage(numbered.withColumn("text_no", F.row_number().over(own) - 1).select("node", "doc_id", "text_no", "text"),
                  "passage-texts")
    return texts, texts.select("node", "doc_id", "text_no")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, text_no, start, end, matched, source_id, source_text_no, source_start, source_end, source_ids.

    Each row is a passage of at least MIN_WORDS words (start..end-1) of a
    document that repeats, exactly or with changes, what an earlier document
    (smaller id) or an earlier place of the same one holds; at least IDENTITY
    of its words match. ``source_id`` is where most of it comes from,
    ``source_ids`` all the documents that it was pieced together from.

    Every text gives the minima of its windows over hashed k-mers as seeds.
    Each occurrence of a seed is joined to the seed's first one (smallest id,
    then place), so a passage in thousands of documents gives one match per
    occurrence. The matches of a document form collinear chains per source;
    chains, also lone anchors, are cut out of both texts, aligned and extended;
    one that agrees only in parts is cut into its stretches that do. Neighbouring
    pieces, also of different sources, make a passage. Any MIN_WORDS words in
    a row that occurred before are found.

    Cases: null and empty texts, texts of fewer than SEED words, and rows
    with a null id have no passages; rows that repeat id and text are one; of
    rows that share an id with different texts each is searched and is a
    source, in the order of ``text_no`` (0 where an id has one text); an empty
    table gives no rows.
    """
    texts, of = _texts(docs)
    found = _repeated(texts.select(F.col("node").alias("doc_id"), "text"))
    order = ["doc_id", "text_no", "start", "end", "matched", "source_id", "source_text_no", "source_start", "source_end", "source_ids"]
    if of is None:
        return found.withColumns({"text_no": F.lit(0), "source_text_no": F.lit(0)}).select(order)
    found = stage(found.withColumn("row", F.monotonically_increasing_id()), "passage-found")
    many = (found.select("row", F.explode("source_ids").alias("node")).join(of, "node")
            .groupBy("row").agg(F.array_sort(F.collect_set("doc_id")).alias("source_ids")))
    theirs = of.select(F.col("node").alias("source_node"), F.col("doc_id").alias("source_id"), F.col("text_no").alias("source_text_no"))
    return (found.drop("source_ids").withColumnRenamed("doc_id", "node").withColumnRenamed("source_id", "source_node")
            .join(of, "node").join(theirs, "source_node").join(many, "row").select(order))


def _repeated(docs: DataFrame) -> DataFrame:
    """The passages of texts that have a key (doc_id) each."""
    docs = docs.withColumn("text", F.col("text").cast("binary"))
    seeds = stage(docs.mapInArrow(_seed_rows, SEED_SCHEMA), "passage-seeds")
    rows = (seeds.select("doc_id", F.explode(F.arrays_zip("seeds", "places")).alias("s"))
            .select(F.col("s.seeds").alias("seed"), "doc_id", F.col("s.places").alias("place")))
    first_here = F.when(F.col("place") >= 0, F.col("doc_id"))
    firsts = stage(rows.groupBy("seed").agg(F.min("doc_id").alias("source_id"), F.min_by("place", first_here).alias("y"),
                                            F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "passage-firsts")
    x = F.when(F.col("place") >= 0, F.col("place")).otherwise(-F.col("place") - 1)
    hits = rows.join(firsts, "seed").select("doc_id", x.alias("x"), "source_id", "y").filter(
        "NOT (doc_id = source_id AND x = y)")
    chains = stage(hits.groupBy("doc_id").agg(F.collect_list(F.struct("source_id", "x", "y")).alias("hits"))
                   .mapInArrow(_chains, PIECE), "passage-chains")
    unstage(seeds, firsts)

    def border(column: str, last: str) -> list:
        # A lone anchor may have to grow to MIN_WORDS on one side.
        lo = F.greatest(F.lit(0), F.element_at(column, 1) - MIN_WORDS)
        hi = F.element_at(column, -1) + SEED + MIN_WORDS
        return [(F.floor(lo / GRID) * GRID).cast("int").alias(f"{last}_lo"),
                (F.ceil(hi / GRID) * GRID).cast("int").alias(f"{last}_hi")]

    placed = chains.select("*", *border("xs", "x"), *border("ys", "y"))
    # The parts that are needed of each text; GRID bounds them by the text's own length.
    wanted = (placed.select("doc_id", F.col("x_lo").alias("lo"), F.col("x_hi").alias("hi"))
              .unionByName(placed.select(F.col("source_id").alias("doc_id"), F.col("y_lo").alias("lo"),
                                         F.col("y_hi").alias("hi"))))
    spans = wanted.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    parts = stage(docs.join(spans.hint("merge"), "doc_id").mapInPandas(_cut, "doc_id long, lo int, hi int, part binary"), "passage-parts")
    here = parts.select("doc_id", F.col("lo").alias("x_lo"), F.col("hi").alias("x_hi"), F.col("part").alias("here"))
    there = parts.select(F.col("doc_id").alias("source_id"), F.col("lo").alias("y_lo"),
                         F.col("hi").alias("y_hi"), F.col("part").alias("there"))
    both = (placed.join(here, ["doc_id", "x_lo", "x_hi"]).join(there, ["source_id", "y_lo", "y_hi"])
            .select("doc_id", "source_id", "xs", "ys", "x_lo", "y_lo", "here", "there"))
    pieces = both.mapInArrow(_aligned, "doc_id long, x0 int, x1 int, source_id long, y0 int, y1 int, same int")
    return (pieces.groupBy("doc_id")
            .agg(F.collect_list(F.struct("x0", "x1", "source_id", "y0", "y1", "same")).alias("pieces"))
            .mapInPandas(_merge, "doc_id long, start int, end int, matched int, source_id long, "
                                 "source_start int, source_end int, source_ids array<long>"))


def cut_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """doc_id and ``text`` without the words of its passages; runs of white space become one space."""
    rows = pick(docs, "doc_id", "text")
    texts, of = _texts(rows)
    spans = passages.groupBy("doc_id", "text_no").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    if of is None:
        docs = rows.join(spans.drop("text_no"), "doc_id", "left")
    else:
        docs = rows.join(texts.drop("node").join(spans, ["doc_id", "text_no"]).drop("text_no"), ["doc_id", "text"], "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for text, found in zip(batch["text"], batch["spans"], strict=True):
                if found is not None and text is not None:
                    w = text.encode().split()
                    gone = np.zeros(len(w), dtype=bool)
                    for s in found:
                        gone[s["start"]:s["end"]] = True
                    text = b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()
                texts.append(text)
            yield batch[["doc_id"]].assign(text=texts)

    return docs.select("doc_id", "text", "spans").mapInPandas(cut, "doc_id long, text string")


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
