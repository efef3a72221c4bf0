"""Connected components by contraction, and small-or-large semi joins. Nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaloom.session import stage

#: ids that are sent to every executor at most; more are joined by a shuffle
BROADCAST_IDS = 1_000_000


def checked(small: DataFrame, rows: int | None = None, most: int = BROADCAST_IDS) -> DataFrame:
    """A narrow staged frame, marked for broadcast if it was counted and is small enough."""
    n = small.count() if rows is None else rows
    return F.broadcast(small) if n <= most else small


def _jumped(parents: DataFrame) -> DataFrame:
    """(u, p) with p the root of u's tree: pointers are doubled until none moves."""
    while True:
        up = parents.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        wide = parents.join(up, "p", "left").select("u", F.coalesce("pp", "p").alias("p2"), "p")
        wide = stage(wide, "jump")
        parents = wide.select("u", F.col("p2").alias("p"))
        if wide.where("p2 <> p").isEmpty():
            return parents


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node with an edge the smallest id that it is connected with.

    Each round points every node to its smallest neighbour, follows the pointers to their roots and
    contracts the edges. A round is a partial aggregate per node, so a node with very many edges is
    no more work for one task than others.
    """
    open_ = stage(edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v")).distinct(), "edges")
    labels = None
    while labels is None or not open_.isEmpty():
        both = open_.unionByName(open_.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        roots = _jumped(stage(nearest, "nearest"))
        if labels is None:
            labels = roots.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            moved = roots.select(F.col("u").alias("root"), F.col("p").alias("to"))
            labels = stage(
                labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels"
            )
        of = roots.select(F.col("u"), F.col("p"))
        left = open_.join(of, "u").select(F.col("p").alias("u"), "v")
        right = left.join(of.select(F.col("u").alias("v"), F.col("p").alias("q")), "v").where("u <> q")
        open_ = stage(right.select(F.least("u", "q").alias("u"), F.greatest("u", "q").alias("v")).distinct(), "edges")
    return labels
