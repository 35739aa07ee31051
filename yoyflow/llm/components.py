"""Connected components of a graph of long ids, by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yoyflow.operators.joins import hashed_join
from yoyflow.session import cut_lineage


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node with an edge; a component is named by its least node.

    A large-star round joins the larger neighbours of every node to its least
    neighbour, a small-star round its smaller ones, until each node hangs on
    the least of its component (the number of rounds grows with the logarithm
    of the size).  Neighbourhoods are never gathered: a minimum is combined in
    the map task and joined back, and adaptive execution can split a node that
    many edges share.  Each round is written out, so that none is run again.
    """
    hi, lo = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = cut_lineage(edges.where(F.col(a) != F.col(b)).select(hi, lo).distinct())
    mark = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = hashed_join(both, _least_neighbour(both), ["u"], how="inner").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = cut_lineage(large.where("u != v").distinct())
        small = hashed_join(large, _least_neighbour(large), ["u"], how="inner")
        ends = F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        now = cut_lineage(small.select(F.explode(ends).alias("e")).select("e.u", "e.v").where("u != v").distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", F.col("v").alias("w")).distinct())
