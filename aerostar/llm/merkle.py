"""Merkle dataset manifest: 16-ary trees a source and over the sources, octopus multiproofs, verification."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostar.llm.common import pick, stage, table

#: Children of a node, and the most leaves that are proved together.
FAN, PART = 16, 512
#: Copies of the nodes from level WIDE_FROM on, which many parts ask for.
COPIES, WIDE_FROM = 16, 2
#: Key of the tree over the sources; those of sources are empty (null) or begin with "=".
TOP = "^"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Manifest(NamedTuple):
    """``leaves``: a row a document with its place; ``nodes``: key, level, idx, n, hash; ``root``: None if empty."""
    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def digest(*values: Column) -> Column:
    """sha256 in lowercase hex of the values, each "-" if null, else byte count, ":", value."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(s), F.lit(":"), s), F.lit("-"))
                             for s in (v.cast("string") for v in values)]), 256)


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add run, part, no: the range of a row, PART rows of it, and its number among those of its key in the range.

    Rows are dealt by range over (key, order), so a large key is spread over
    many tasks; rows equal in all of these are interchangeable.
    """
    dealt = [F.col("key"), *order]
    ranged = rows.withColumn("tie", F.rand(1)).repartitionByRange(*dealt, "tie").sortWithinPartitions(*dealt, "tie").drop("tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, seen, key, no = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            numbers = []
            for k in batch.column("key").to_pylist():
                key, no = (key, no + 1) if k == key else (k, 0)
                numbers.append(no)
            at = np.arange(seen, seen + len(numbers))
            seen += len(numbers)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(at), here)), pa.array((here << 32) + at // PART), pa.array(numbers, pa.int64())],
                [*batch.schema.names, "run", "part", "no"])

    plain = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema)
    return stage(ranged.mapInArrow(run, f"{plain}, run long, part long, no long"), "merkle-numbered")


def _starts(numbered: DataFrame) -> DataFrame:
    """key, run, start, n: where the rows of a key in a range begin, and how many the key has."""
    own = Window.partitionBy("key")
    before = own.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return (numbered.groupBy("key", "run").agg(F.count(F.lit(1)).alias("own"))
            .select("key", "run", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("start"),
                    F.sum("own").over(own).alias("n")))


def _tree(level: DataFrame) -> DataFrame:
    """All nodes above and with the leaves ``level`` (key, idx, n, hash), a staged table a level."""
    level = level.select("key", F.lit(0).alias("level"), "idx", "n", "hash")
    nodes, most = level, level.agg(F.max("n")).first()[0] or 0
    at = 0
    while most > 1:
        at, most = at + 1, -(-most // FAN)
        run = F.transform(F.array_sort(F.collect_list(F.struct("idx", "hash"))), lambda x: x["hash"])
        level = stage(level.filter("n > 1")
                      .groupBy("key", F.floor(F.col("idx") / FAN).alias("up"), F.ceil(F.col("n") / FAN).alias("m"))
                      .agg(F.sha2(F.array_join(run, ""), 256).alias("hash"))
                      .select("key", F.lit(at).alias("level"), F.col("up").alias("idx"), F.col("m").alias("n"), "hash"),
                      f"merkle-level{at}")
        nodes = nodes.unionByName(level)
    return nodes


def manifest(docs: DataFrame, changed: DataFrame | None = None) -> Manifest:
    """The trees over all rows of ``docs``: a leaf a row, a tree a source, one over the sources.

    ``docs`` needs the columns FIELDS. Leaves ascend by doc_id within their
    source; every FAN consecutive nodes become one until one is left. Sources
    ascend bytewise, null first.

    Cases: null ids come first; rows that share an id ascend by their leaf;
    repeated rows are leaves each; an empty table has no nodes and no root.
    """
    base = pick(docs, *FIELDS)
    leaf = digest(*[F.col(f) for f in FIELDS])
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source")))
    rows = stage(base.select("doc_id", key.alias("key"), leaf.alias("hash"), tampered(base).alias("bad")), "merkle-leaves")
    numbered = _numbered(rows, [F.col("doc_id"), F.col("hash")])
    starts = stage(_starts(numbered), "merkle-starts")
    sources = _numbered(starts.select("key").distinct().select(F.lit(TOP).alias("key"), F.col("key").alias("source")),
                        [F.col("source")])
    tops = sources.join(_starts(sources), ["key", "run"]).select(
        F.col("source").alias("key"), (F.col("start") + F.col("no")).alias("top"), F.col("n").alias("n_top"))
    leaves = stage(numbered.join(starts.join(tops, "key"), ["key", "run"]).select(
        "part", "doc_id", "key", (F.col("start") + F.col("no")).alias("idx"), "n", "top", "n_top", "hash", "bad"), "merkle-placed")
    below = _tree(leaves.select("key", "idx", "n", "hash"))
    above = _tree(below.filter("n = 1").join(stage(tops, "merkle-tops"), "key")
                  .select(F.lit(TOP).alias("key"), F.col("top").alias("idx"), F.col("n_top").alias("n"), "hash"))
    above = stage(above, "merkle-top")
    root = above.filter("n = 1").first()
    return Manifest(leaves, below.unionByName(above), root.hash if root else None)


def tampered(docs: DataFrame) -> Column:
    """The leaf of a document whose text is lower-cased (A-Z), where 5 divides the crc32 of its id; else null."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.translate("text", UPPER, UPPER.lower())
    return F.when(hit, digest(*[F.col(f) for f in FIELDS[:-1]], text))


def missing(known: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each level the nodes that proofs of the leaves ``known`` need and that can't be derived from them.

    Octopus: what the runs of the known nodes lack is needed; then their
    parents are known. ``known`` ascends, without repeats.
    """
    level = 0
    while n > 1:
        runs = np.unique(known // FAN)
        whole = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        yield level, np.setdiff1d(whole[whole < n], known, assume_unique=True)
        known, n, level = runs, -(-n // FAN), level + 1


class Branch:
    """The nodes of one tree that a part holds, derives or has fetched."""

    def __init__(self, n: int, held: dict[int, str], fetched: dict[tuple[int, int], str]):
        self.widths, self.levels = [n], [held]
        while self.widths[-1] > 1:
            at, wide = len(self.levels) - 1, self.widths[-1]
            up = {}
            for run in {i // FAN for i in self.levels[-1]}:
                for i in range(run * FAN, min(run * FAN + FAN, wide)):
                    if i not in self.levels[-1]:
                        self.levels[-1][i] = fetched[at, i]
                up[run] = sha256("".join(self._run(at, run)).encode()).hexdigest()
            self.levels.append(up)
            self.widths.append(-(-wide // FAN))
        self.root = self.levels[-1][0]
        self._paths: dict[tuple[int, int], str] = {}

    def _run(self, level: int, run: int) -> list[str]:
        return [self.levels[level][i] for i in range(run * FAN, min(run * FAN + FAN, self.widths[level]))]

    def path(self, level: int, idx: int) -> str:
        """Siblings from this node up to the root, left to right."""
        if level == len(self.levels) - 1:
            return ""
        got = self._paths.get((level, idx))
        if got is None:
            own = self._run(level, idx // FAN)
            del own[idx % FAN]
            got = "".join(own) + self.path(level + 1, idx // FAN)
            if level:
                self._paths[level, idx] = got
        return got

    def fold(self, value: str, idx: int) -> str:
        """The root as it follows from ``value`` in place of leaf ``idx`` and the siblings."""
        for level in range(len(self.levels) - 1):
            own = self._run(level, idx // FAN)
            own[idx % FAN] = value
            value, idx = sha256("".join(own).encode()).hexdigest(), idx // FAN
        return value


def _by_tree(rows: list[dict]) -> dict[str, tuple[int, np.ndarray]]:
    """key -> (n, places wanted), the tree over the sources included."""
    places: dict[str, set[int]] = {TOP: {r["top"] for r in rows}}
    sizes = {TOP: rows[0]["n_top"]}
    for r in rows:
        places.setdefault(r["key"], set()).add(r["idx"])
        sizes[r["key"]] = r["n"]
    return {k: (sizes[k], np.array(sorted(v))) for k, v in places.items()}


def proofs(m: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, folded_root, verified of ``leaves``, rows of ``m.leaves`` (default: all).

    A part of at most PART leaves computes which nodes its proofs lack, all of
    them together, fetches each once, derives the interiors that its leaves
    share, and writes the proofs out. ``proof`` has the siblings (hex) from
    the leaf's run up to the root. ``folded_root`` is what they give with the
    leaf, the tampered one (``bad``) where there is one.

    Cases: without leaves there are no rows; a lone leaf has an empty proof.
    """
    leaves = m.leaves if leaves is None else leaves
    rows = F.collect_list(F.struct("doc_id", "key", "idx", "n", "top", "n_top", "hash", "bad"))
    parts = stage(leaves.groupBy("part").agg(rows.alias("leaves")), "merkle-parts")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, held in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out = [(k, level, idx) for k, (n, places) in _by_tree(held.as_py()).items()
                       for level, lack in missing(places, n) for idx in lack.tolist()]
                if out:
                    keys, levels, idx = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(out), pa.int64()), pa.array(keys, pa.string()), pa.array(levels, pa.int32()),
                         pa.array(idx, pa.int64())], ["part", "key", "level", "idx"])

    # Upper nodes are asked for by every part of their tree: they are copied, and parts spread over the copies.
    wide = F.col("level") >= WIDE_FROM
    asked = parts.mapInArrow(ask, "part long, key string, level int, idx long").withColumn(
        "copy", F.when(wide | (F.col("key") == TOP), F.col("part") % COPIES).otherwise(0).cast("int"))
    spread = m.nodes.select("key", "level", "idx", "hash", F.explode(
        F.when(wide | (F.col("key") == TOP), F.sequence(F.lit(0), F.lit(COPIES - 1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    fetched = (asked.join(spread, ["key", "level", "idx", "copy"]).groupBy("part")
               .agg(F.collect_list(F.struct("key", "level", "idx", "hash")).alias("nodes")))
    root = m.root

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, got in zip(batch.column("leaves"), batch.column("nodes"), strict=True):
                held = held.as_py()
                others: dict[str, dict] = {}
                for x in got.as_py() or ():
                    others.setdefault(x["key"], {})[x["level"], x["idx"]] = x["hash"]
                own: dict[str, dict] = {}
                for r in held:
                    own.setdefault(r["key"], {})[r["idx"]] = r["hash"]
                sizes = {r["key"]: r["n"] for r in held}
                trees = {k: Branch(sizes[k], at, others.get(k, {})) for k, at in own.items()}
                top = Branch(held[0]["n_top"], {r["top"]: trees[r["key"]].root for r in held}, others.get(TOP, {}))
                out = [(r["doc_id"], r["hash"], trees[r["key"]].root, top.root,
                        trees[r["key"]].path(0, r["idx"]) + top.path(0, r["top"]),
                        top.fold(trees[r["key"]].fold(r["bad"] or r["hash"], r["idx"]), r["top"])) for r in held]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 names)

    names = ["doc_id", "leaf", "subroot", "root", "proof", "folded_root"]
    id_kind = leaves.schema["doc_id"].dataType.simpleString()
    kinds = [pa.string() if id_kind == "string" else pa.int32() if id_kind == "int" else pa.int64(), *[pa.string()] * 5]
    proved = parts.join(fetched, "part", "left").mapInArrow(
        prove, f"doc_id {id_kind}, leaf string, subroot string, root string, proof string, folded_root string")
    return proved.withColumn("verified", F.col("folded_root") == F.lit(root))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Every document's proof, digested, and the root that its leaf, tampered or not, folds to."""
    found = proofs(manifest(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
                        "folded_root", "verified")


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in (*FIELDS[:-1], text)) + ")"


SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
leaves AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key, {_leaf("text")} AS leaf,
    CASE WHEN xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c))),
      lambda a, b: xor(a // 256, t[1 + xor(a, b) % 256])), 4294967295) % 5 = 0 THEN {_leaf("translate(text, '" + UPPER + "', '" + UPPER.lower() + "')")}
    ELSE {_leaf("text")} END AS now
  FROM documents, crc_table),
placed AS (
  SELECT *, row_number() OVER (ORDER BY key, doc_id NULLS FIRST, leaf) AS id,
    row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY key) AS n FROM leaves),
below(key, level, idx, n, hash) AS (
  SELECT key, 0, idx, n, leaf FROM placed
  UNION ALL
  SELECT key, level + 1, idx // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(hash, '' ORDER BY idx))
  FROM below WHERE n > 1 GROUP BY key, level, idx // {FAN}, n),
sources AS (
  SELECT key, hash AS subroot, row_number() OVER (ORDER BY encode(key)) - 1 AS idx, count(*) OVER () AS n
  FROM below WHERE n = 1),
above(level, idx, n, hash) AS (
  SELECT 0, idx, n, subroot FROM sources
  UNION ALL
  SELECT level + 1, idx // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(hash, '' ORDER BY idx))
  FROM above WHERE n > 1 GROUP BY level, idx // {FAN}, n),
nodes AS (
  SELECT key, level, idx, n, hash FROM below UNION ALL SELECT '{TOP}', level, idx, n, hash FROM above),
sides AS (
  SELECT a.key, a.level, a.idx,
    coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.key = b.key AND a.level = b.level AND a.idx // {FAN} = b.idx // {FAN}
  WHERE a.n > 1 GROUP BY ALL),
walk(id, key, level, idx, proof, now) AS (
  SELECT id, key, 0, idx, '', now FROM placed
  UNION ALL
  SELECT w.id, w.key, w.level + 1, w.idx // {FAN}, w.proof || s.l || s.r, sha256(s.l || w.now || s.r)
  FROM walk w JOIN sides s USING (key, level, idx)),
climbed AS (
  SELECT w.* FROM walk w LEFT JOIN sides s USING (key, level, idx) WHERE s.key IS NULL),
climb(id, level, idx, proof, now) AS (
  SELECT c.id, 0, s.idx, c.proof, c.now FROM climbed c JOIN sources s USING (key)
  UNION ALL
  SELECT w.id, w.level + 1, w.idx // {FAN}, w.proof || s.l || s.r, sha256(s.l || w.now || s.r)
  FROM climb w JOIN sides s ON s.key = '{TOP}' AND s.level = w.level AND s.idx = w.idx)
SELECT p.doc_id, p.leaf, s.subroot, r.hash AS root, sha256(c.proof) AS proof_sha256, c.now AS folded_root,
  c.now = r.hash AS verified
FROM placed p
JOIN sources s USING (key)
JOIN (SELECT w.* FROM climb w LEFT JOIN sides s ON s.key = '{TOP}' AND s.level = w.level AND s.idx = w.idx
      WHERE s.key IS NULL) c USING (id)
CROSS JOIN (SELECT hash FROM above WHERE n = 1) r
"""
