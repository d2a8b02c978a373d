"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostar.llm.common import stage, unstage


def _roots(parent: DataFrame) -> DataFrame:
    """Follow ``parent`` (node, root; root < node) to the end by pointer doubling."""
    now = stage(parent, "cc-parent")
    while True:
        up = now.select(F.col("node").alias("root"), F.col("root").alias("above"))
        step = stage(now.join(up, "root", "left").select(
            "node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "cc-parent")
        unstage(now)
        now = step
        if now.filter("moved").isEmpty():
            return now


def _through(df: DataFrame, name: str, roots: DataFrame) -> DataFrame:
    at = roots.select(F.col("node").alias(name), F.col("root").alias("_to"))
    return df.join(at, name, "left").withColumn(name, F.coalesce("_to", name)).drop("_to")


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for each node of ``links`` (a, b longs).

    Each round hooks every node to its smallest smaller neighbour, flattens
    the trees and contracts the links; all tables are written, so a round
    stands on its own. Nothing of it meets on the driver but "is it empty".
    """
    edges = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .filter("a < b").distinct(), "cc-links")
    labels = stage(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                   .withColumn("root", F.col("node")), "cc-labels")
    while not edges.isEmpty():
        roots = _roots(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")))
        new_labels = stage(_through(labels, "root", roots).select("node", "root"), "cc-labels")
        moved = _through(_through(edges, "a", roots), "b", roots).filter("a <> b")
        new_edges = stage(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                          .distinct(), "cc-links")
        unstage(labels, edges, roots)
        labels, edges = new_labels, new_edges
    return labels
