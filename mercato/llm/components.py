"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.shared import stored


def components(links: DataFrame, *, max_rounds: int = 50) -> DataFrame:
    """(node, component) of every node of ``links`` (a long, b long); component: its least node.

    Every round each node hands its least neighbour to the others (large star to the
    larger ones, small star to the smaller ones), so paths shorten geometrically. A hub's
    neighbours are never paired; its minimum is combined before the shuffle. One row
    with a count and a sum reaches the driver each round.
    """
    edges = stored(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        # from here on each row points from the larger node to the smaller
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = stored(small.filter("a <> b").distinct(), "links")
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.max("a")
        ).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
