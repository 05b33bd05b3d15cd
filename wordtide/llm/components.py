"""Connected components of a table of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordtide.llm.tables import drop, written


def components(links: DataFrame) -> DataFrame:
    """`node, label` of all nodes of `links` (`a, b`); the label is the least node of the component.

    Each round takes the least label among neighbours and then that label's own label, so
    the reach of a label doubles from round to round. A node with very many links is no hot
    key: labels of neighbours are reduced to a minimum on all tasks first, and the skewed
    side of the join can be split.
    """
    rows = 2 * links.count()
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = written(links.select("a", "b").union(turned).distinct(), "links", rows)
    nearest = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = written(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels", rows)
    total = F.sum(F.col("label").cast("decimal(38,0)"))
    before = labels.agg(total).first()[0]
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(around.withColumnRenamed("a", "node"), "node").select(
            "node", F.least("label", "near").alias("label")
        )
        roots = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = step.join(roots, "label").select("node", F.least("label", "root").alias("label"))
        later = written(jumped, "labels", rows)
        after = later.agg(total).first()[0]
        drop(labels)
        labels = later
        if after == before:
            drop(both)
            return labels
        before = after


def merged(labels: DataFrame, links: DataFrame, rows: int) -> DataFrame:
    """`labels` (`node, label`) after further links between nodes of it.

    Only the graph of the classes that the links join is worked through.
    """
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    between = links.join(a, "a").join(b, "b").where("label_a <> label_b")
    roots = components(between.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct())
    roots = roots.select(F.col("node").alias("label"), F.col("label").alias("root"))
    joined = labels.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return written(joined, "labels", rows)
