"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum; two numbers whatever the table's size."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def components(edges: DataFrame, path: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with a link; component is the smallest node reachable.

    edges: columns a, b; self-links, repeats and nulls are ignored. Alternates large-star and
    small-star steps, which need O(log^2 n) rounds; each round is a partial aggregate and a join
    on the node, so a node with very many links is split by AQE and never gathered. Each round is
    written to ``path``.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{path}/cc0")
    before = _state(edges)
    for k in range(1, max_rounds + 1):
        if before[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = stored(large, f"{path}/cc{k}a")
        small = large.join(_least(large), "u")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(small.select("u", F.col("low").alias("v")))
        edges = stored(small.where("u <> v").distinct(), f"{path}/cc{k}b")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    low = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return low.unionByName(low.select(F.col("component").alias("node"), "component").distinct()).distinct()
