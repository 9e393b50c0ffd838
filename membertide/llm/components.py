"""Connected components by distributed union-find on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membertide.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the component's smallest node.

    In a round each node hooks to its smallest neighbour if that is smaller, follows the hook once
    more, and the links are contracted to where their ends went; links within one place are gone. A
    component's smallest node never moves, the others do, so rounds grow with the logarithm of the
    component and the links shrink from round to round. Steps and links are written tables; the steps are
    put together at the end. Minima are combined before the shuffle, so a hot node costs a row a
    task. Nodes are longs; self-links and repeated links do no harm.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.union(both.select(F.col("other"), F.col("node"))).filter("node <> other").distinct()
    edges = scratch.table(both, "edges")
    roots, place = edges.select("node").distinct().withColumn("root", F.col("node")), F.coalesce("to", "root")
    while edges.limit(1).count():
        hooks = edges.groupBy("node").agg(F.least("node", F.min("other")).alias("to"))
        onward = hooks.select(F.col("node").alias("to"), F.col("to").alias("further"))
        steps = scratch.table(hooks.join(onward, "to").select("node", F.col("further").alias("to")), "steps")
        moved = edges.join(steps, "node").select(F.col("to").alias("node"), "other")
        moved = moved.join(steps.withColumnsRenamed({"node": "other", "to": "end"}), "other").select("node", F.col("end").alias("other"))
        edges = scratch.table(moved.filter("node <> other").distinct(), "edges")
        roots = roots.join(steps.withColumnRenamed("node", "root"), "root", "left").select("node", place.alias("root"))
    return scratch.table(roots, "roots")
