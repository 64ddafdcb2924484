"""Connected components of a graph that only executors hold."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (long columns a and b), root the smallest node that
    can be reached.

    Alternating large and small stars: every node hands its smallest neighbour to the larger
    ones, then to the smaller ones, until nothing changes, which takes a number of rounds that
    grows with the logarithm of the graph. Each step is written to the shared folder. Smallest
    neighbours are aggregated on the map side and joined from a written table, so adaptive
    execution can split the rows of a node with many neighbours.
    """
    lower = F.least("a", "b").alias("v")
    now = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), lower)
                      .distinct(), "components")
    before = None
    while (state := now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
           .first()) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = cut_lineage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")),
                              "components")
        large = cut_lineage(both.where("v > u").join(nearest, "u")
                            .select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .distinct(), "components")
        nearest = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")), "components")
        now = cut_lineage(
            large.join(nearest, "u").where("v <> m").select(F.col("v").alias("u"), "m")
            .unionByName(nearest).select("u", F.col("m").alias("v")).distinct(), "components")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
