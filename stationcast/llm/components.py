"""Connected components of large graphs by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.store import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node that has an edge: (node, component).

    ``edges`` has two columns of longs, a and b, in any direction; repeated edges and loops do no
    harm. Each round hangs the larger neighbours of every node below its smallest neighbour, then the
    smaller ones, until only stars are left; the number of rounds grows with the logarithm of the
    longest path. Neighbour lists are never gathered: a round is a minimum per node, combined on the
    map side, and a join that Spark can split where one node has many edges. Each round is stored.
    """
    a, b = F.col("a"), F.col("b")
    current = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                     .where("a > b").distinct(), "edges")
    before = None
    while True:
        both = current.unionByName(current.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(b.alias("a"), F.col("m").alias("b"))
                 .where("a > b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (joined.where("b <> m").select(b.alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        current = stored(small, "edges")
        # A round that changes nothing leaves the same edges: compare their number and hash sum.
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return (current.select(a.alias("node"), b.alias("component"))
            .unionByName(current.select(b.alias("node"), b.alias("component")).distinct()))
