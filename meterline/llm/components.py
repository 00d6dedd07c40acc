"""Connected components of an edge table, wholly in Spark.

Alternates the large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014): both keep the components and move every node nearer to the smallest node of its own.
The minimum of a node's neighbours is a partial aggregate, and it is joined back instead of gathering
neighbours, so that a node of very many edges never becomes one large group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, spread


def _lowest(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.min("v").alias("m"))


def _with_lowest(e: DataFrame, low: DataFrame) -> DataFrame:
    return e.join(spread(low), "u")


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that has an edge to another one; the component is its smallest
    node.  Nulls and loops are ignored."""
    e = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = keep(e)
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (_with_lowest(both, low).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = _lowest(large)
        small = (_with_lowest(large, low).where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = keep(small)
        before, state = state, _state(e)
        if before == state:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
