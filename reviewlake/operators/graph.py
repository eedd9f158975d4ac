"""Connected components of an edge table, without bringing edges to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.session import checkpointed


def _size_and_hash(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node that each node of the edge table can reach.

    Alternating large-star and small-star rounds; every round is two aggregations with map-side combine and two
    equi-joins, so a node with very many neighbours is split by adaptive skew handling. Self loops and null ends are
    ignored, so a node that has no other edge is absent from the result. An empty table gives an empty result.
    """
    pairs = edges.select(F.greatest(u, v).cast("long").alias("u"), F.least(u, v).cast("long").alias("v"))
    e = checkpointed(pairs.filter("u is not null and v is not null and u <> v").distinct())
    before = _size_and_hash(e)
    if before[0] == 0:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")
        )
        e = checkpointed(small.select("x.u", "x.v").filter("u <> v").distinct())
        after = _size_and_hash(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
