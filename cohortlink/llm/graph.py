"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, written


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every end of the links (a, b); the label is the smallest id of the component.

    In each round every node takes its smallest neighbour, or itself, as parent,
    follows parents twice, and the links are redrawn between parents. Rounds are
    few, as paths shrink by a factor; nothing but a count reaches the driver.
    """
    with scratch(links.sparkSession):
        return written(_components(links), "components", outside=True)


def _components(links: DataFrame) -> DataFrame:
    links = written(links.where("a <> b").distinct(), "links")
    labels = None
    while True:
        ends = links.union(links.select(F.col("b"), F.col("a")))
        parents = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        parents = written(parents.select("node", F.least("node", "parent").alias("parent")), "parents")
        for _ in range(2):
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("over"))
            parents = parents.join(up, "parent").select("node", F.col("over").alias("parent"))
        parents = written(parents, "parents")
        if labels is None:
            labels = parents.select(F.col("node").alias("id"), F.col("parent").alias("label"))
        else:
            step = parents.select(F.col("node").alias("label"), "parent")
            labels = labels.join(step, "label", "left").select("id", F.coalesce("parent", "label").alias("label"))
            labels = written(labels, "labels")
        first = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        second = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        links = links.join(first, "a").join(second, "b").where("pa <> pb")
        links = written(links.select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "links")
        if links.isEmpty():
            return labels
