"""Connected components of a table of links, by repeated hooking to the smallest neighbour and shortcutting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): the smallest node it can reach.

    A round gives each node the smallest label among its neighbours, then the label of that label, and writes the
    labels to the shared folder, so a lost executor costs one round at most. What a label has reached doubles with
    each round.
    """
    links = links.where("a is not null and b is not null and a <> b").select("a", "b")
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        own = labels.select("node", "label", F.col("label").alias("old"))
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("old"))
        lower = own.unionByName(near).groupBy("node").agg(F.min("label").alias("low"), F.max("old").alias("old"))
        above = labels.select(F.col("node").alias("up_node"), F.col("label").alias("up"))
        moved = lower.join(above, F.col("low") == F.col("up_node"), "left").withColumn("label", F.least("low", "up"))
        moved = stored(moved.select("node", "label", (F.col("label") < F.col("old")).alias("moved")), "labels")
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links: only the links between components are solved."""
    by = lambda c: labels.select(F.col("node").alias(f"{c}_node"), F.col("label").alias(f"{c}_label"))
    between = links.join(by("a"), F.col("a") == F.col("a_node"), "left").join(by("b"), F.col("b") == F.col("b_node"), "left")
    between = between.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")).where("a <> b").distinct()
    between = stored(between, "between")
    if between.isEmpty():
        return labels
    merged = components(between)
    after = labels.join(merged.select(F.col("node").alias("of"), F.col("label").alias("to")), F.col("label") == F.col("of"), "left")
    after = after.select("node", F.coalesce("to", "label").alias("label"))
    fresh = merged.join(labels.select(F.col("node").alias("known")), F.col("node") == F.col("known"), "left_anti")
    return stored(after.unionByName(fresh), "labels")
