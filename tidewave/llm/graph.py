"""Connected components by repeated contraction, for graphs that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewave.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the undirected ``edges`` (a, b), both long; component: its smallest node.

    In a round every node hooks onto its smallest neighbour, pointers jump once, and the edges are renamed; this
    at least halves the nodes that still have edges, so rounds grow with the logarithm of the largest component.
    The minimum is combined before the shuffle, and the joins carry pairs of ids, whose hot keys AQE splits.
    Null ends and self-loops are ignored; an empty input gives an empty result.
    """
    work = stored(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    found = None
    while not work.isEmpty():
        ends = work.unionByName(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = (
            ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
            .select("node", F.least("node", "up").alias("up"))
        )
        jump = stored(
            hook.join(hook.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", "top"),
            "hooks",
        )
        if found is None:
            found = jump.select("node", F.col("top").alias("component"))
        else:
            found = stored(
                found.join(jump.select(F.col("node").alias("component"), "top"), "component", "left")
                .select("node", F.coalesce("top", "component").alias("component")),
                "found",
            )
        work = stored(
            work.join(jump.select(F.col("node").alias("a"), F.col("top").alias("ta")), "a")
            .join(jump.select(F.col("node").alias("b"), F.col("top").alias("tb")), "b")
            .where(F.col("ta") != F.col("tb"))
            .select(F.greatest("ta", "tb").alias("a"), F.least("ta", "tb").alias("b"))
            .distinct(),
            "edges",
        )
    if found is None:
        found = work.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found
