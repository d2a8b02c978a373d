"""Line dedup by winnowing over line hashes (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostar.llm.common import pick, stage, word_count

#: A fingerprint hashes this many lines.
GRAM = 2
#: One fingerprint is taken from each window of so many; at least GRAM + WINDOW - 1 lines
#: that repeat in a row always share one. WINDOW <= GRAM, so neighbours touch.
WINDOW = 2
#: Shorter runs stay.
MIN_RUN = GRAM + WINDOW - 1


def _content(text: Column) -> Column:
    """Lines that hold more than white space, trimmed, with their place: array of (at, line)."""
    lines = F.transform(F.split(text, "\n"),
                        lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(" \t\r\x0b\x0c")).alias("line")))
    return F.filter(lines, lambda x: x["line"] != "")


def _gram(hashes: Column, start: Column, n: int) -> Column:
    """128-bit hash of ``n`` line hashes from ``start`` (0-based)."""
    return F.md5(F.concat(*[F.get(hashes, start + j) for j in range(n)]).cast("binary"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, print, key, lo, n: the content lines lo..lo+n-1 of a document as ``key``.

    Each fingerprint (the window minimum, the rightmost of equals) gives its
    GRAM lines, and the same extended by up to WINDOW - 1 lines to the left or
    to the right.
    """
    rows = (pick(docs, "doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
            .select("doc_id", F.xxhash64("text").alias("print"), _content(F.col("text")).alias("c"))
            .withColumn("m", F.size("c")).filter(F.col("m") >= MIN_RUN))
    rows = rows.withColumn("h", F.transform("c", lambda x: F.md5(x["line"].cast("binary"))))
    rows = rows.withColumn("g", F.transform(
        F.sequence(F.lit(0), F.col("m") - GRAM),
        lambda i: F.struct(_gram(F.col("h"), i, GRAM).alias("k"), (-i).alias("p"))))
    minima = F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("g") - WINDOW + 1),
        lambda i: F.array_min(F.slice(F.col("g"), i, WINDOW))))
    rows = rows.select("doc_id", "print", "h", "m", F.explode(minima).alias("f"))
    rows = rows.select("doc_id", "print", "h", "m", F.col("f.k").alias("k"), (-F.col("f.p")).alias("p"))
    spans = [F.struct(F.col("k").alias("key"), F.col("p").alias("lo"), F.lit(GRAM).alias("n"))]
    for j in range(1, WINDOW):
        left, right = F.col("p") - j, F.col("p")
        spans.append(F.when(left >= 0, F.struct(_gram(F.col("h"), left, GRAM + j).alias("key"),
                                                left.alias("lo"), F.lit(GRAM + j).alias("n"))))
        spans.append(F.when(right + GRAM + j <= F.col("m"),
                            F.struct(_gram(F.col("h"), right, GRAM + j).alias("key"),
                                     right.alias("lo"), F.lit(GRAM + j).alias("n"))))
    return (rows.select("doc_id", "print", F.explode(F.array_compact(F.array(*spans))).alias("s"))
            .select("doc_id", "print", F.unhex("s.key").alias("key"), "s.lo", "s.n"))


def long_marks(docs: DataFrame, words: int) -> DataFrame:
    """As fingerprints: each run of fewer than MIN_RUN lines that has ``words`` words or more."""
    rows = (pick(docs, "doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
            .select("doc_id", F.xxhash64("text").alias("print"), _content(F.col("text")).alias("c")))
    rows = (rows.withColumn("m", F.size("c")).filter("m > 0")
            .withColumn("w", F.transform("c", lambda x: word_count(x["line"])))
            .filter(F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x) >= words)
            .withColumn("h", F.transform("c", lambda x: F.md5(x["line"].cast("binary")))))

    def spans_of(n: int) -> Column:
        def span(i: Column) -> Column:
            size = sum((F.get("w", i + j) for j in range(1, n)), F.get("w", i))
            return F.when((i + n <= F.col("m")) & (size >= words),
                          F.struct(_gram(F.col("h"), i, n).alias("key"), i.alias("lo"), F.lit(n).alias("n")))

        return F.array_compact(F.transform(F.sequence(F.lit(0), F.col("m") - 1), span))

    spans = F.concat(*[spans_of(n) for n in range(1, MIN_RUN)])
    return (rows.select("doc_id", "print", F.explode(spans).alias("s"))
            .select("doc_id", "print", F.unhex("s.key").alias("key"), "s.lo", "s.n"))


def repeated_runs(docs: DataFrame, long_words: int | None = None) -> DataFrame:
    """doc_id, print, runs: the runs (lo, hi) of content lines that repeat earlier ones."""
    marks = fingerprints(docs).withColumn("long", F.lit(False))
    if long_words is not None:
        # A run shorter than MIN_RUN has so many words if and only if it holds one of these.
        marks = marks.unionByName(long_marks(docs, long_words).withColumn("long", F.lit(True)))
    here = F.struct("doc_id", "print", "lo")
    firsts = stage(marks.groupBy("key").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("times"))
                   .filter("times > 1").select("key", "first"), "line-firsts")
    later = marks.join(firsts, "key").filter(here > F.col("first"))
    lines = later.select("doc_id", "print", "long", F.explode(
        F.sequence(F.col("lo"), F.col("lo") + F.col("n") - 1)).alias("line"))
    nth = F.dense_rank().over(Window.partitionBy("doc_id", "print").orderBy("line"))
    runs = (lines.withColumn("island", F.col("line") - nth)
            .groupBy("doc_id", "print", "island")
            .agg(F.min("line").alias("lo"), F.max("line").alias("hi"), F.max("long").alias("long"))
            .filter((F.col("hi") - F.col("lo") + 1 >= MIN_RUN) | F.col("long")))
    return runs.groupBy("doc_id", "print").agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("runs"))


def dedup_lines(docs: DataFrame, long_words: int | None = None) -> DataFrame:
    """All columns of ``docs`` with the cleaned ``text``, then n_lines and n_removed.

    The lines of a document that hold more than white space are hashed,
    trimmed; fingerprints are the window minima over hashes of GRAM lines. A
    fingerprint that an earlier place has too (in the order of doc_id, then of
    the hash of the text, then of the line) is a match, extended both ways by
    what earlier places share. Matched lines in a row, MIN_RUN or more, are
    deleted, each with the blank lines that follow it. A run of MIN_RUN lines
    that occurred before is always found; a single repeated line, or a run
    shorter than MIN_RUN, stays, unless it has ``long_words`` words or more.

    Cases: rows with null id or text are returned as they are and match
    nothing; rows that repeat id and text are one document, neither is later;
    an empty text stays empty; an empty table gives no rows. n_lines counts
    content lines (null text: 0). Columns of ``docs`` named like the two new
    ones give way to them.
    """
    drops = stage(repeated_runs(docs, long_words), "line-drops")
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = (F.col(f"c{names.index(n)}") for n in ("doc_id", "text"))
    # As many documents as have repeats: a merge join at every size.
    joined = rows.withColumn("_print", F.xxhash64(text)).join(
        drops.hint("merge"), (key == drops["doc_id"]) & (F.col("_print") == drops["print"]), "left")
    joined = joined.withColumn("_at", F.transform(_content(text), lambda x: x["at"]))
    lines, n = F.split(text, "\n"), F.size("_at")
    gone = F.flatten(F.transform("runs", lambda r: F.sequence(r["lo"], r["hi"])))
    kept = F.array_except(F.sequence(F.lit(0), n - 1), gone)
    ends = F.concat(F.col("_at"), F.array(F.size(lines)))
    body = F.flatten(F.transform(kept, lambda i: F.slice(
        F.col("_lines"), F.get(F.col("_at"), i) + 1, F.get(F.col("_ends"), i + 1) - F.get(F.col("_at"), i))))
    joined = (joined.withColumn("_lines", F.when(F.col("runs").isNotNull(), lines))
              .withColumn("_ends", F.when(F.col("runs").isNotNull(), ends)))
    lead = F.slice("_lines", F.lit(1), F.get("_at", F.lit(0)))
    clean = F.when(F.col("runs").isNull(), text).otherwise(
        F.array_join(F.concat(lead, body), "\n"))
    removed = F.coalesce(F.size(F.when(F.col("runs").isNotNull(), gone)), F.lit(0))
    out = [(clean if c == "text" else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)
           if c not in ("n_lines", "n_removed") and (c != "text" or i == names.index("text"))]
    return joined.select(*out, F.coalesce(F.greatest(n, F.lit(0)), F.lit(0)).alias("n_lines"),
                         F.greatest(removed, F.lit(0)).alias("n_removed"))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "text", "n_lines", "n_removed")


SQL = r"""
WITH lines AS (
  SELECT doc_id, len(string_split(text, chr(10))) AS total,
         unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
content AS (
  SELECT *, md5(trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12))) AS h,
         row_number() OVER d - 1 AS line, count(*) OVER (PARTITION BY doc_id) AS m
  FROM lines WHERE trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> ''
  WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
grams AS (
  SELECT doc_id, line, m, h,
         lag(h) OVER d AS h0, lead(h) OVER d AS h2, lead(h, 2) OVER d AS h3,
         md5(h || lead(h) OVER d) AS g, md5(lead(h) OVER d || lead(h, 2) OVER d) AS g_next
  FROM content WHERE m >= 3
  WINDOW d AS (PARTITION BY doc_id ORDER BY line)),
picked AS (
  SELECT DISTINCT doc_id, CASE WHEN g < g_next THEN line ELSE line + 1 END AS line
  FROM grams WHERE g IS NOT NULL AND g_next IS NOT NULL),
marks AS (
  SELECT doc_id, line AS lo, 2 AS n, md5(h || h2) AS key FROM grams JOIN picked USING (doc_id, line)
  UNION ALL
  SELECT doc_id, line - 1, 3, md5(h0 || h || h2) FROM grams JOIN picked USING (doc_id, line) WHERE h0 IS NOT NULL
  UNION ALL
  SELECT doc_id, line, 3, md5(h || h2 || h3) FROM grams JOIN picked USING (doc_id, line) WHERE h3 IS NOT NULL),
later AS (
  SELECT doc_id, lo, n FROM marks
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, lo) > 1
      AND (doc_id, lo) <> first_value((doc_id, lo)) OVER (PARTITION BY key ORDER BY doc_id, lo)),
hit AS (SELECT DISTINCT doc_id, lo + j AS line FROM later, range(3) t(j) WHERE j < n),
islands AS (
  SELECT doc_id, line, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS island FROM hit),
gone AS (
  SELECT doc_id, line FROM islands
  QUALIFY count(*) OVER (PARTITION BY doc_id, island) >= 3),
owner AS (
  SELECT l.doc_id, l.pos, l.raw, c.line IS NOT NULL AS is_content,
         max(c.line) OVER (PARTITION BY l.doc_id ORDER BY l.pos ROWS UNBOUNDED PRECEDING) AS line
  FROM lines l LEFT JOIN content c ON l.doc_id = c.doc_id AND l.pos = c.pos),
cleaned AS (
  SELECT o.doc_id,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (g.line IS NULL), '') AS text,
         count(*) FILTER (is_content) AS n_lines,
         count(*) FILTER (is_content AND g.line IS NOT NULL) AS n_removed
  FROM owner o LEFT JOIN gone g ON o.doc_id = g.doc_id AND o.line = g.line
  GROUP BY o.doc_id)
SELECT d.doc_id, CASE WHEN c.n_removed > 0 THEN c.text ELSE d.text END AS text,
       CAST(coalesce(c.n_lines, 0) AS INTEGER) AS n_lines,
       CAST(coalesce(c.n_removed, 0) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id
"""
