"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeworks.llm.common import split_heavy_join
from gradeworks.session import stage


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); the nodes of a component share their root.

    Every round gives each node the smallest of itself and its neighbours as its label and
    contracts the graph to labels. Links stay between labels of one component, so the rounds
    end when no link is left; the labels are then followed back. A node with very many links
    meets its label by broadcast, not in one task.
    """
    edges = stage(links.select("a", "b").where("a <> b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct(), "edges")
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        labels = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label"), F.count(F.lit(1)).alias("n"))
        labels = stage(labels, "labels")
        levels.append(labels)
        near = split_heavy_join(edges, labels.withColumnRenamed("label", "x"), ["a"], "inner", 24)
        far = split_heavy_join(near, labels.select(F.col("a").alias("b"), F.col("label").alias("y"), "n"), ["b"], "inner", 24)
        edges = stage(far.select(F.col("x").alias("a"), F.col("y").alias("b")).where("a <> b").distinct(), "edges")
    if not levels:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).where("false")
    out = levels[0].select(F.col("a").alias("node"), F.col("label").alias("root"))
    for labels in levels[1:]:
        step = labels.select(F.col("a").alias("root"), "label")
        out = out.join(step, "root", "left").select("node", F.coalesce("label", "root").alias("root"))
    return stage(out, "components")
