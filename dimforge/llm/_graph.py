"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm._common import Scratch


def components(edges: DataFrame, scratch: Scratch, tag: str = "cc") -> DataFrame:
    """(node, root): the smallest node reachable from every node of ``edges``
    (columns a, b of one comparable type; nodes without edges do not occur).

    Alternating large-star and small-star steps (Kiveris et al., 2014): in
    each, a node links its larger (or its smaller) neighbours to the smallest
    one, until every edge leads to a root.  Each step is two grouped
    aggregations at most, its result is written, so the lineage stays short
    and a node with many edges is never gathered in one place: the join that
    hands the minimum to the edges has plain shuffles on both sides.
    """
    e = (edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = scratch.write(e, f"{tag}-0")
    step, last = 0, None
    while True:
        step += 1
        # large star: neighbours above a node move to the node's smallest neighbour (itself included)
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{tag}-{step}-low")
        e1 = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
              .filter("u <> v").distinct())
        e1 = scratch.write(e1, f"{tag}-{step}-large")
        # small star: a node and its smaller neighbours move to the smallest of them
        low = scratch.write(e1.groupBy("u").agg(F.min("v").alias("m")), f"{tag}-{step}-min")
        e2 = (e1.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v").filter("u <> v").distinct())
        e2 = scratch.write(e2, f"{tag}-{step}")
        sign = e2.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        scratch.drop(*([f"{tag}-{step - 1}"] if step > 1 else [f"{tag}-0"]),
                     f"{tag}-{step}-low", f"{tag}-{step}-large", f"{tag}-{step}-min")
        e = e2
        if last == (sign["n"], sign["h"]):
            break
        last = (sign["n"], sign["h"])
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
