"""Distributed connected components by random contraction.

Every round each node points at the neighbour (or itself) with the smallest priority, a hash that changes
with the round; edges are rewritten to the pointed-at nodes and loops and repeats dropped.  Priorities in
random order shrink chains, stars and cliques alike by a constant share per round, so the number of rounds
grows with the logarithm of the longest path.  The pointers of each round are kept and composed backwards.

Minima are taken with partial aggregation, so a hub with a third of all edges sends one row per task; the
joins that rewrite edges have one row per node on the other side, which lets skewed partitions be split, and
that side is broadcast once at most BROADCAST_NODES nodes are left (their number falls from round to round).
Each round is written to the shared scratch folder, and so are the composed pointers of every WRITE_EACH rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlake.llm.common import at_most, written

# Nodes whose pointers are sent to every worker at most; with more, edges are joined with them by shuffle.
BROADCAST_NODES = 200_000
WRITE_EACH = 4


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node in an edge; component is the smallest node it reaches.

    Null ends and loops link nothing; an empty edge table gives an empty result.  Nodes may be of any
    ordered type."""
    kind = edges.schema[a].dataType
    left = written(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
        .filter("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc_edges")
    steps: list[tuple[DataFrame, bool]] = []
    small = False
    while not left.isEmpty():
        salt = F.lit(len(steps))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = F.struct(F.xxhash64("b", salt).alias("p"), F.col("b").alias("n"))
        mine = F.struct(F.xxhash64("a", salt).alias("p"), F.col("a").alias("n"))
        point = written(both.groupBy("a").agg(F.min(order).alias("m"))
                        .select(F.col("a").alias("node"), F.least("m", mine)["n"].alias("to")), "cc_point")
        small = small or at_most(point, BROADCAST_NODES)
        steps.append((point, small))
        side = F.broadcast(point) if small else point
        left = written(
            left.join(side.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a")
            .join(side.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
            .filter("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "cc_edges")
    if not steps:
        return edges.sparkSession.createDataFrame([], "node string, component string").select(
            F.col("node").cast(kind), F.col("component").cast(kind))
    root, small = steps[-1]
    for n, (point, small_point) in enumerate(reversed(steps[:-1]), 1):
        later = root.select(F.col("node").alias("to"), F.col("to").alias("last"))
        root = point.join(F.broadcast(later) if small else later, "to", "left").select("node", F.coalesce("last", "to").alias("to"))
        root, small = written(root, "cc_root") if n % WRITE_EACH == 0 else root, small_point
    root = written(root, "cc_root")
    least = root.groupBy("to").agg(F.min("node").alias("component"))
    return root.join(F.broadcast(least) if small else least, "to").select("node", "component")
