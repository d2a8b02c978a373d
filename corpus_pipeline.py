"""The corpus pipeline: toxicity, line dedup, near duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostar.llm.common import stage, table
from aerostar.llm.line_dedup import dedup_lines
from aerostar.llm.mixing import mixed
from aerostar.llm.ngram_join import Rule, one_of_each
from aerostar.llm.packing import pack
from aerostar.llm.toxicity import without_toxic

#: Near duplicates share 0.8 of their five-word shingles; op9 has a rule of its own.
NEAR = Rule(5, 80, 100)
#: Repeated runs of one or two lines go if they have so many words; the rule of op5 is its SQL's, three lines.
LONG_RUN = 50


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifiers reject go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; so does a document of which nothing is left.

    n_chars follows the text where it changed.
    """
    names = docs.columns
    at = {names.index("doc_id"): "doc_id", names.index("text"): "text"}
    cleaned = dedup_lines(docs.toDF(*[at.get(i, f"c{i}") for i in range(len(names))]), LONG_RUN)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    size = f"c{names.index('n_chars')}"
    length = F.when(F.col("n_removed") == 0, F.col(size)).otherwise(F.length("text"))
    return (cleaned.filter(left).withColumn(size, length.cast("long"))
            .select(*[at.get(i, f"c{i}") for i in range(len(names))]).toDF(*names))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_of_each(docs, NEAR)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or up to three times."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, bucket, padded_len, batch, slot of each document of the mix."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("source_mix", source_mix), ("packing", packing)]

#: SQL can't express the classifiers; tests hold near duplicates and long runs of lines against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
