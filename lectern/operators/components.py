"""Connected components of an undirected link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import materialize


def _nearest(edges: DataFrame) -> DataFrame:
    """Each node with its smallest neighbour or itself, aggregated map-side first."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node on a link; the component is its smallest node.

    Alternates large-star and small-star steps, which take a number of rounds
    logarithmic in the longest path. Every step aggregates before it joins, so
    a hub is combined map-side and its join is split by AQE. Null ends and
    loops to the same node link nothing; repeated links count once. An empty
    table gives an empty result.
    """
    edges = (
        links.select(F.col(a).alias("p"), F.col(b).alias("q"))
        .where(F.col("p").isNotNull() & F.col("q").isNotNull() & (F.col("p") != F.col("q")))
        .select(F.greatest("p", "q").alias("u"), F.least("p", "q").alias("v"))
        .distinct()
    )
    edges = materialize(edges, "links")
    before = None
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_nearest(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small_in = large.distinct()
        nearest = _nearest(small_in)
        joined = small_in.join(nearest, "u")
        small = (
            joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(nearest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = materialize(small, "links")
        sign = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if sign == before:
            break
        before = sign
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
