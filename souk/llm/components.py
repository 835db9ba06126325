"""Connected components of a links table by alternating large and small stars.

Every step is a minimum per vertex and a join; links stay in tables of the shared folder and are
never collected. The minima are shuffled to the join on their own, so that adaptive execution can
split a vertex with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from souk.llm.common import stored


def _with_minima(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least of u and its neighbours."""
    minima = edges.groupBy("u").agg(F.min("v").alias("m"))
    # u is computed anew: Spark then shuffles both sides to the join, and can split them
    return edges.join(minima.select(F.greatest("u", "u").alias("u"), F.least("u", "m").alias("m")), "u")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each vertex points to one root, and no root points on."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("root")).union(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("root"))
    )
    of_vertex = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
    return of_vertex.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("root") > 0))).isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, component) of every linked vertex; the component is its smallest vertex."""
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    seen = Observation()
    edges = stored(pairs, "links", seen, F.count("*").alias("n"))
    while seen.get["n"] and not _are_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minima(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large, "large-star")
        small = _with_minima(large).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(large.groupBy("u").agg(F.min("v").alias("v")))
        edges = stored(small.where("u > v").distinct(), "small-star")
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots)
