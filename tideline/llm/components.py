"""Connected components of a table of links, by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node in the links (a, b); the component is its least id.

    Each turn takes the least label among neighbours and then the label of the label, so
    turns grow with the logarithm of the longest path. Labels of each turn are written to
    the shared folder; joins read written tables on both sides, so that adaptive execution
    can split a node with very many links. No links give no rows.
    """
    pairs = links.select("a", "b").where("a <> b").distinct()
    edges = stored(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stored(
        edges.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")), "labels"
    )
    while True:
        near = edges.join(labels.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), "label")
        lower = stored(near.union(labels).groupBy("id").agg(F.min("label").alias("label")), "labels")
        jump = lower.select(F.col("id").alias("label"), F.col("label").alias("further"))
        jumped = stored(
            lower.join(jump, "label").select("id", F.least("label", "further").alias("label")), "labels"
        )
        before = labels.select("id", F.col("label").alias("before"))
        if jumped.join(before, "id").where("label <> before").isEmpty():
            return jumped.select("id", F.col("label").alias("component"))
        labels = jumped
