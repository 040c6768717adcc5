"""Connected components of links by contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosslex.sources import workspace


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of the links; the component is its smallest node.

    In each round every node points to the smallest of its neighbours and itself, pointers
    are followed one step further, and links are moved to where their ends point. Each
    round takes away every node that is not the smallest around it, so a few rounds leave no
    link. Sums by node are partial before their shuffle, joins of one node with many links
    can be split; nothing but counts reaches the driver. Null ends are left out.
    """
    edges = workspace.settle(
        links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v").select(
            F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    moved: DataFrame | None = None  # node, where it has come to
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = workspace.settle(
            both.groupBy("u").agg(F.min("v").alias("v")).select(
                F.col("u").alias("node"), F.least("u", "v").alias("to")), "nearest")
        # Two steps at once: a pointer's pointer.
        onward = nearest.select(F.col("node").alias("to"), F.col("to").alias("further"))
        pointers = workspace.settle(
            nearest.join(onward, "to").select("node", F.col("further").alias("to")), "pointers")
        if moved is None:
            moved = pointers
        else:
            step = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
            older = moved.join(step, "to", "left").select(
                "node", F.coalesce("next", "to").alias("to"))
            moved = workspace.settle(older, "moved")
        ends = pointers.select(F.col("node").alias("u"), F.col("to").alias("to_u"))
        other = pointers.select(F.col("node").alias("v"), F.col("to").alias("to_v"))
        edges = workspace.settle(
            edges.join(ends, "u").join(other, "v").where("to_u != to_v").select(
                F.least("to_u", "to_v").alias("u"),
                F.greatest("to_u", "to_v").alias("v")).distinct(), "links")
    if moved is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return moved.select("node", F.col("to").alias("component"))
