"""Connected components of a link table, by least-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import discard, settle


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b): label is the least node that can be reached.

    Each round takes the least label among neighbours, then the label of that label, so the rounds grow with the
    logarithm of a chain's length; stars, which copies form, need two. All state is in the shared folder; only the
    number of changed labels reaches the driver.
    """
    both = settle(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    labels = held = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(around, labels["node"] == around["a"]).select("node", F.least("label", "near").alias("next"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("then"))
        after = settle(lower.join(jump, "next", "left").select("node", F.coalesce("then", "next").alias("label"), (F.coalesce("then", "next") != F.col("was")).alias("moved")))
        discard(held)
        held, labels = after, after.select("node", "label")
        if after.filter("moved").isEmpty():
            discard(both)
            return labels
