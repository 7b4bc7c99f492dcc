"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordgate.llm.common import materialise


def _roots(edges: DataFrame, order) -> DataFrame:
    """node, root: each node points to the least by ``order`` of itself and its neighbours, and goes on to the end; rows are nodes, not edges."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy(F.col("src").alias("node")).agg(F.min(F.struct(order(F.col("dst")).alias("o"), "dst")).alias("near"))
    own = F.struct(order(F.col("node")).alias("o"), F.col("node").alias("dst"))
    known = materialise(least.select("node", F.least("near", own)["dst"].alias("root")))
    while True:
        further = known.select(F.col("node").alias("at"), F.col("root").alias("further"))
        after = materialise(known.join(further, F.col("root") == F.col("at")).select("node", "further", (F.col("root") != F.col("further")).alias("moved")))
        known = after.select("node", F.col("further").alias("root"))
        if not after.filter("moved").limit(1).count():
            return known


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of the undirected ``edges`` (src, dst; longs, no nulls).

    Each round makes one node of what points to one root and keeps the edges between different
    roots, once each, so edges are joined while they are still needed only. Every fourth round
    points by a hash of its own: then at least half of the nodes that have edges are expected to
    go, whatever their ids. Rounds are written to the shared folder.
    """
    left = materialise(edges.filter("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct())
    turn, labels = 0, None
    while True:
        roots = _roots(left, (lambda c, t=turn: F.xxhash64(c, F.lit(t))) if turn % 4 == 3 else lambda c: c)
        if labels is None:
            labels = roots
        else:
            step = roots.select(F.col("node").alias("at"), F.col("root").alias("further"))
            labels = materialise(labels.join(step, F.col("root") == F.col("at"), "left").select("node", F.coalesce("further", "root").alias("root")))
        of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        met = left.join(of("src"), "src").join(of("dst"), "dst").filter("src_root <> dst_root")
        left = materialise(met.select(F.least("src_root", "dst_root").alias("src"), F.greatest("src_root", "dst_root").alias("dst")).distinct())
        turn += 1
        if left.isEmpty():
            break
    least = labels.groupBy("root").agg(F.min("node").alias("component"))
    return materialise(labels.join(least, "root").select("node", "component"))
