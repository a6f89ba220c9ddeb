"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hublytics.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b: long): comp is the same
    exactly for connected nodes.

    Every round lets each node point to its smallest neighbour (or itself),
    follows the pointers once more, and replaces the edges by those between
    the nodes pointed to. Only nodes smaller than all their neighbours
    survive a round, at most half of those that still have an edge, so the
    rounds grow with the logarithm of the nodes. Each round reads written
    tables, so a hub with very many edges can be split over tasks.
    """
    edges = cut(edges.select("a", "b").where("a <> b").distinct(), "cc-edges")
    steps: list[DataFrame] = []
    while edges.limit(1).count():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("to")), "cc-near")
        further = near.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        point = cut(near.join(further, "to").select("node", F.col("beyond").alias("to")), "cc-point")
        steps.append(point)
        left = point.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        right = point.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        edges = cut(edges.join(left, "a").join(right, "b").where("a2 <> b2")
                    .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "cc-edges")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    out = steps[0].select("node", F.col("to").alias("comp"))
    for step in steps[1:]:
        on = step.select(F.col("node").alias("comp"), "to")
        out = out.join(on, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    return cut(out, "cc")
