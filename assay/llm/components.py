"""Connected components by repeated contraction, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import discard, written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long): ``component``
    is the smallest node reachable.

    Each round every node points at the neighbour (or itself) that comes first,
    and the graph is replaced by the graph of those targets. Rounds go by the
    node's number, which ends stars around their smallest node at once, and by
    an order drawn anew in turn, which shrinks chains by a constant factor. Only
    nodes that still have an edge stay in a round. Nothing is collected.
    """
    e = written(edges.select("a", "b").where("a <> b")
                .select(F.explode(F.array(F.struct("a", "b"),
                                          F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                        .alias("e")).select("e.*").distinct(), "cc-edges")
    levels, turn = [], 0
    while not e.isEmpty():
        def rank(c, t=turn):
            return F.col(c) if t % 2 == 0 else F.xxhash64(F.lit(t), F.col(c))
        first = e.groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), F.col("b").alias("v"))).alias("m"))
        own = F.struct(rank("a").alias("r"), F.col("a").alias("v"))
        to = written(first.select(F.col("a").alias("node"), F.least("m", own)["v"].alias("root")), "cc-roots")
        levels.append(to)
        left = to.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = to.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        old, e = e, written(e.join(left, "a").join(right, "b").where("ra <> rb")
                    .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "cc-edges")
        discard(old)
        turn += 1
    discard(e)
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    last = levels[-1]
    for to in reversed(levels[:-1]):
        up = last.select(F.col("node").alias("up"), F.col("root").alias("top"))
        last = (to.join(up, to["root"] == up["up"], "left")
                .select("node", F.coalesce("top", "root").alias("root")))
    last = written(last, "cc-labels")
    discard(*levels)
    least = last.groupBy("root").agg(F.min("node").alias("component"))
    return last.join(least, "root").select("node", "component")
