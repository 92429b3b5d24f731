"""Connected components of an edge table by label hooking and shortcutting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.llm.staging import drop_folder, stage_at


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label every vertex of ``edges(u, v)`` with the smallest vertex of its component.

    Each round passes the smallest neighbouring label to a vertex and to the
    vertex its label names, then replaces every label by its label's label, so
    chains shrink geometrically.  Labels are staged after each round; the driver
    sees one count.  Self-loops, repeated edges and an empty table are allowed;
    null endpoints are ignored.  Returns ``(vertex, component)``.
    """
    spark = edges.sparkSession
    edges = edges.where("u is not null and v is not null")
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both, both_at = stage_at(both, "edges")
    labels, at = stage_at(
        both.groupBy(F.col("u").alias("vertex")).agg(F.least(F.col("u"), F.min("v")).alias("component")), "labels"
    )
    for _ in range(max_rounds):
        near = (
            both.join(labels, both.v == labels.vertex)
            .groupBy("u")
            .agg(F.min("component").alias("low"))
            .join(labels, F.col("u") == labels.vertex)
            .select("vertex", "component", "low")
        )
        offers = near.select("vertex", F.least("component", "low").alias("offer")).union(
            near.where("low < component").select(F.col("component").alias("vertex"), F.col("low").alias("offer"))
        )
        hooked = offers.groupBy("vertex").agg(F.min("offer").alias("component"))
        up = hooked.select(F.col("vertex").alias("parent"), F.col("component").alias("up"))
        after = (
            hooked.join(up, hooked.component == up.parent)
            .join(labels.select("vertex", F.col("component").alias("before")), "vertex")
            .select("vertex", F.least("component", "up").alias("component"), "before")
        )
        after, after_at = stage_at(after, "labels")
        moved = after.where("component <> before").limit(1).count()
        drop_folder(spark, at)
        labels, at = after.select("vertex", "component"), after_at
        if not moved:
            drop_folder(spark, both_at)
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
