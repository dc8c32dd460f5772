"""Connected components by contraction, without a graph on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _roots(parents: DataFrame) -> DataFrame:
    """Follow (node, parent), where parents are smaller, to the end."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("_next"))
        jumped = written(
            parents.join(above, "parent", "left").select(
                "node",
                F.coalesce("_next", "parent").alias("parent"),
                F.col("_next").isNotNull().alias("_moved"),
            ),
            "jumped",
        )
        parents = jumped.select("node", "parent")
        if jumped.where("_moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (a, b): root is the smallest node reachable.

    Every node hooks to its smallest neighbour if that is smaller, trees are
    flattened, and links between trees go on as links between their roots. A
    round at least halves the trees that have links left.
    """
    links = written(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b")
        .distinct(),
        "links",
    )
    known: DataFrame | None = None
    while not links.isEmpty():
        roots = _roots(
            links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        )
        if known is None:
            known = roots
        else:
            # Earlier roots move on; nodes that are hooked now for the first time join.
            moved = roots.select(F.col("node").alias("root"), F.col("parent").alias("_next"))
            known = written(
                known.withColumnRenamed("parent", "root")
                .join(moved, "root", "left")
                .select("node", F.coalesce("_next", "root").alias("parent"))
                .unionByName(roots.join(known.select("node"), "node", "left_anti")),
                "known",
            )
        to = lambda end: roots.select(F.col("node").alias(end), F.col("parent").alias(f"_{end}"))
        links = written(
            links.join(to("a"), "a", "left")
            .join(to("b"), "b", "left")
            .select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a < b")
            .distinct(),
            "links",
        )
    if known is None:
        return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    # The smallest node of a component is its own root.
    own = known.select(F.col("parent").alias("node")).distinct()
    return known.unionByName(own.select("node", F.col("node").alias("parent"))).select(
        "node", F.col("parent").alias("root")
    ).distinct()
