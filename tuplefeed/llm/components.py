"""Connected components of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuplefeed.llm.common import settled


def connected(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, component): for each node of ``links`` (a, b), the smallest node it reaches.

    Each round takes the smallest label among neighbours, then the label of that label, so that
    long chains shrink by halves. Labels are pre-aggregated before they are shuffled, and each
    round is written to the shared folder.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = settled(both.where("a <> b").distinct(), f"{name}-edges")
    labels = settled(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), f"{name}-labels")
    while True:
        of = labels.select(F.col("a").alias("b"), F.col("label").alias("near"))
        least = edges.join(of, "b").groupBy("a").agg(F.min("near").alias("near"))
        lower = labels.join(least, "a").select("a", "label", F.least("label", "near").alias("next"))
        onward = labels.select(F.col("a").alias("next"), F.col("label").alias("jump"))
        moved = lower.join(onward, "next", "left").select(
            "a", "label", F.least("next", F.coalesce("jump", F.col("next"))).alias("next")
        )
        stepped = settled(moved, f"{name}-labels")
        if stepped.where("next < label").isEmpty():
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))
        labels = stepped.select("a", F.col("next").alias("label"))
