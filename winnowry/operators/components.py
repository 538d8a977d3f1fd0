"""Connected components of an edge list by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.session import cut


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, component): the smallest id that each node of ``edges`` is connected to.

    Every round takes the least label among the neighbours and then the label of that label, so the rounds grow with
    the logarithm of the longest chain. Each round is written to the shared folder: lineage stays short, and a lost
    executor costs a reread. Nulls in either end make no edge; self-loops and repeated edges change nothing.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    both = cut(e.union(e.select("b", "a")).distinct(), "cc-edges")
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), "cc-0")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("seen"))
        low = labels.join(near, "id").select("id", "label", F.least("label", "seen").alias("low"))
        jump = low.select(F.col("id").alias("low"), F.col("low").alias("beyond"))
        new = low.join(jump, "low", "left").select(
            "id", F.least("low", F.coalesce("beyond", "low")).alias("new"), F.col("label").alias("old")
        )
        new = cut(new, "cc")
        labels = new.select("id", F.col("new").alias("label"))
        if new.filter("new <> old").limit(1).count() == 0:
            return labels.select("id", F.col("label").alias("component"))
