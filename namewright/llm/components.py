"""Connected components of a graph of links, without gathering links or labels anywhere.

Every node that has a smaller neighbour hooks onto the smallest; pointer jumping turns the forest
into stars; links between different stars go on to the next round.  Aggregations are
combined before they shuffle and the joins are left to adaptive execution, so a node with very many links
is no hot spot.  Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.storage import drop, keep


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): each linked node and the smallest node that it is connected with.

    Nulls link nothing; repeated links and loops are allowed.
    """
    edges = keep(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct())
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    labels = keep(nodes.withColumn("label", F.col("node")))
    while not edges.isEmpty():
        roots = _stars(edges)
        named = roots.select(F.col("u").alias("label"), F.col("p"))
        old, labels = labels, keep(labels.join(named, "label", "left").select("node", F.coalesce("p", "label").alias("label")))
        drop(old)
        one = edges.join(roots, "u", "left").select(F.coalesce("p", "u").alias("x"), "v")
        two = one.join(roots.withColumnRenamed("u", "v"), "v", "left").select("x", F.coalesce("p", "v").alias("y"))
        nxt = two.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
        old, edges = edges, keep(nxt)
        drop(old)
        drop(roots)
    drop(edges)
    return labels


def _stars(edges: DataFrame) -> DataFrame:
    """(u, p): p is the root of u's tree when every u hangs on its smallest smaller neighbour."""
    roots = keep(edges.groupBy("u").agg(F.min("v").alias("p")))
    while True:
        up = roots.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        jumped = keep(roots.join(up, "p", "left").select("u", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")))
        drop(roots)
        roots = jumped
        if jumped.where("moved").isEmpty():
            return roots
