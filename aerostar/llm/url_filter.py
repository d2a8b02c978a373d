"""URL filter: listed rules first, boosted trees over lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostar.llm.common import pick, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, rule): a rule is a host and the start of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Labelled urls that the trees are fitted on, at most about so many, dealt by a hash.
MAX_TRAIN = 200_000
#: Pseudo-urls by which the block rate of a suffix is drawn to the overall rate.
SMOOTHING = 20.0
TREES, DEPTH, SEED = 12, 4, 7

NUMERIC = ("url_len", "host_len", "path_len", "depth", "labels", "digit_ratio", "entropy",
           "params", "hyphens", "has_fragment", "segment_len", "extension_len")
SUFFIXES = ("tld", "domain")


def parse(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruled: the longest rule that fits and its verdict."""
    rows = pick(pages, "page_id", "url")
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url")))
    rows = rows.withColumn("rest", rest)
    host = F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), UPPER, LOWER)
    rows = rows.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"),
                       F.coalesce(F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"))
    rule = ruled = None
    for verdict, text in sorted(rules, key=lambda r: -len(r[1])):
        owner, slash, tail = text.partition("/")
        fits = ((F.col("host") == owner) | F.col("host").endswith(f".{owner}")) & F.col("path").startswith(slash + tail)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        ruled = F.when(fits, verdict) if ruled is None else ruled.when(fits, verdict)
    none = F.lit(None).cast("string")
    return rows.withColumn("rule", none if rule is None else rule).withColumn(
        "ruled", none if ruled is None else ruled)


def _entropy(text: Column) -> Column:
    """Bits per character of the distribution of characters."""
    n = F.length(text)
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.coalesce(F.aggregate(
        F.array_distinct(chars), F.lit(0.0),
        lambda acc, c: acc - (lambda p: p * F.log2(p))(
            (n - F.length(F.replace(text, c, F.lit("")))) / n)), F.lit(0.0))


def lexical(parsed: DataFrame) -> DataFrame:
    """Numeric features of the url's characters, and its suffixes ``tld`` and ``domain``."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    name = F.element_at(F.split(path, "/"), -1)
    features = {
        "url_len": F.length(url), "host_len": F.length(host), "path_len": F.length(path),
        "depth": F.regexp_count(path, F.lit(r"/[^/]+")), "labels": F.size(labels),
        "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)),
        "entropy": _entropy(url),
        "params": F.regexp_count(query, F.lit("[^&]+")), "hyphens": F.regexp_count(url, F.lit("[-_]")),
        "has_fragment": F.instr(url, "#") > 0,
        "segment_len": F.length(path) / F.greatest(F.regexp_count(path, F.lit("/")), F.lit(1)),
        "extension_len": F.length(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1)),
    }
    return parsed.select("*", *[v.cast("int").cast("double").alias(k) if k == "has_fragment"
                                else v.cast("double").alias(k) for k, v in features.items()],
                         F.element_at(labels, -1).alias("tld"),
                         F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)).alias("domain"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score.

    Urls that a rule fits take its verdict, and are the labelled urls that the
    boosted trees learn from. ``score`` is the trees' probability of 'block';
    a url without a rule is blocked at 0.5 or more. Suffix statistics are the
    number of labelled urls of a suffix and its smoothed block rate; they come
    from one half of the labelled urls (by hash), the trees from the other.

    Cases: a null url, or one without ``://``, has an empty host and path and
    is scored on the features of an empty text; when the labelled urls are
    none, or all alike, there is nothing to learn and the others take that
    one verdict ('allow' if none), score 1 or 0 (when only the trees' half is
    alike, the block rate of the top-level domain decides). Repeated rows are
    judged each; an empty table gives no rows.
    """
    rows = parse(pages, rules)
    label = F.when(F.col("ruled") == "block", 1.0).when(F.col("ruled") == "allow", 0.0)
    featured = stage(lexical(rows).withColumn("label", label).drop("url"), "url-features")
    total = featured.agg(F.count("label").alias("n"), F.sum("label").alias("blocked")).first()
    n, blocked = total["n"], total["blocked"] or 0.0
    out = ["page_id", "host", "path", "rule"]
    if blocked in (0.0, float(n)):
        score = F.lit(1.0 if n and blocked else 0.0)
        return featured.select(*out, F.coalesce("ruled", F.lit("block" if n and blocked else "allow")).alias("verdict"),
                               score.alias("score"))
    prior = blocked / n
    # One half of the labelled urls gives the suffix statistics, the other the trees.
    slot = F.pmod(F.xxhash64("host", "path", "page_id"), F.lit(1 << 20))
    known = featured.withColumn("slot", slot)
    for s in SUFFIXES:
        stats = (known.filter("label IS NOT NULL AND slot % 2 = 0").groupBy(s)
                 .agg(F.count(F.lit(1)).alias(f"{s}_n"), F.sum("label").alias(f"{s}_blocked")))
        known = known.join(stats, s, "left")
        seen = F.coalesce(f"{s}_n", F.lit(0))
        known = (known.withColumn(f"{s}_count", F.log1p(seen.cast("double")))
                 .withColumn(f"{s}_rate", (F.coalesce(f"{s}_blocked", F.lit(0.0)) + SMOOTHING * prior)
                             / (seen + SMOOTHING)))
    inputs = [*NUMERIC, *[f"{s}_{k}" for s in SUFFIXES for k in ("count", "rate")]]
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(known)
    most = int(min(1.0, 2 * MAX_TRAIN / n) * (1 << 20))
    train = stage(vectors.filter((F.col("slot") % 2 == 1) & (F.col("slot") < most) & F.col("label").isNotNull())
                  .select("features", "label"), "url-train")
    if train.select("label").distinct().count() < 2:
        return known.select(*out, F.coalesce("ruled", F.when(F.col("tld_rate") >= 0.5, "block").otherwise("allow"))
                            .alias("verdict"), F.col("tld_rate").alias("score"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED,
                          featuresCol="features", labelCol="label").fit(train)
    scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*out, F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"),
                         "score")


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
