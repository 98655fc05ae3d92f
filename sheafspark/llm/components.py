"""Connected components of a graph of longs, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafspark.storage import written_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of each node with the least of them: the larger ones, or the smaller ones and the node."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both if large else both.where("b < a")
    # stored, so that the join below can split a node with very many neighbours
    least = written_table(
        side.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "component-least"
    )
    joined = side.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("m").alias("a"), "b")
    else:
        moved = joined.select(F.col("m").alias("a"), "b").unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return moved.where("a != b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``links`` (a long, b long); the root is the smallest node of the component.

    Each round stores its edges in the shared folder and cuts the lineage. Rounds grow with the logarithm of the
    longest path. Loops are ignored; no links give an empty table.
    """
    edges = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = written_table(edges, "component-edges")
    check = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"))
    seen = edges.agg(check.alias("c")).first().c
    while seen.n:
        # (root, member) edges only, each member once: nothing is left to join
        edges = written_table(_star(_star(edges, large=True), large=False), "component-edges")
        now = edges.agg(check.alias("c")).first().c
        if now == seen:
            break
        seen = now
    members = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return members.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
