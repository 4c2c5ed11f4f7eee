"""Connected components of an undirected graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` -> ``(node, root)``: the smallest node that each linked node can reach.

    Every round, each node's root hooks onto the smallest root next to it, then roots are followed
    one step further. Rounds grow with the logarithm of the longest chain. All of it is minima with
    partial aggregation and plain joins, so that a node with very many links never meets in one
    group. Each round's state is a written table. Nodes without a link are not in the result.
    """
    both = store(
        links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(),
        "components-links",
    )
    state = store(
        both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("root")),
        "components-round",
    )
    while True:
        near = (
            both.join(state, both.b == state.node).groupBy("a").agg(F.min("root").alias("near")).withColumnRenamed("a", "node")
        )
        seen = state.join(near, "node").select("node", "root", F.least("root", "near").alias("least"))
        # a node's old root learns of the smallest root that any of its nodes has seen
        hooks = seen.groupBy("root").agg(F.min("least").alias("hook")).withColumnRenamed("root", "node")
        hooked = seen.join(hooks, "node", "left").select(
            "node", F.col("root").alias("old"), F.least("least", F.coalesce("hook", "least")).alias("root")
        )
        hooked = store(hooked, "components-hook")
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = store(
            hooked.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("next", "root")).alias("root")),
            "components-round",
        )
        if after.filter("old <> root").isEmpty():
            return after.select("node", "root")
        state = after.select("node", "root")
