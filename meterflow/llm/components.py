"""Connected components by spreading the least label, written to the shared checkpoint folder after each round.

Rounds are written as Parquet: a checkpoint keeps the planner's size estimate,
and estimates of joins multiply, round by round, into numbers of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the least node that links reach.

    Each round gives every node the least root among its own, its neighbours'
    and that of the node its root names, which halves settled paths. Rounds end
    when none changes. The work of a round grows with the number of edges, so
    callers give few edges a node (stars, forests), each once, not all links.
    """
    both = written(edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("to"))).where("node <> to"), "links")
    state = written(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("root")), "roots")
    while True:
        offers = both.join(state.select(F.col("node").alias("to"), "root"), "to").select("node", "root")
        best = state.unionByName(offers).groupBy("node").agg(F.min("root").alias("root"))
        step = best.join(state.select(F.col("node").alias("root"), F.col("root").alias("beyond")), "root").select(
            "node", F.least("root", "beyond").alias("root"))
        new = written(step.join(state.select("node", F.col("root").alias("was")), "node"), "roots")
        changed = new.where("root <> was").limit(1).count()
        state = new.select("node", "root")
        if not changed:
            return state
