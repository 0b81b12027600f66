"""Connected components of an undirected graph as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import counted, discard, in_few_tasks, settle


def connected_components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """``edges`` (a, b) -> (node, root): one row per node that has an edge, root
    being the smallest node of its component. ``most``, where known, is a number of rows
    that ``edges`` does not exceed.

    Each round points every node at its smallest neighbour, follows the pointer
    once more, and contracts the edges to the nodes pointed at. A star takes one round;
    where nodes are numbered by hashes, as here, a round leaves a fixed part of any
    path. All tables stay distributed; each round is written to the scratch folder, so
    lost executors do not replay the rounds before, and counts its edges as it
    writes them. Self-loops, repeated edges and null ends are allowed and ignored.
    """
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b").distinct()
    edges, left = counted(edges if most is None else in_few_tasks(edges, most))
    ends = 2 * left  # and nodes at most
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = settle(in_few_tasks(nodes.select("node", F.col("node").alias("root")), ends))
    while left:
        near = in_few_tasks(edges.union(edges.select("b", "a")).groupBy("a").agg(F.min("b").alias("b"))
                            .select(F.col("a").alias("node"), F.least("a", "b").alias("up")), 2 * left)
        jump = settle(in_few_tasks(near.join(near.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", "top"), 2 * left))
        old = (roots, edges, jump)
        roots = settle(in_few_tasks(roots.join(jump.select(F.col("node").alias("root"), "top"), "root", "left")
                                    .select("node", F.coalesce("top", "root").alias("root")), ends))
        edges, left = counted(in_few_tasks(edges.join(jump.select(F.col("node").alias("a"), F.col("top").alias("ta")), "a")
                                           .join(jump.select(F.col("node").alias("b"), F.col("top").alias("tb")), "b")
                                           .filter("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                                           .distinct(), left))
        discard(*old)
    return roots
