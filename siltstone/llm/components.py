"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import kept


def _tied(edges: DataFrame, purpose: str, larger: bool) -> DataFrame:
    """One pass over edges (a < b): around each vertex, its larger (or its smaller) neighbours
    are tied to the least vertex there, and so is the vertex itself in the pass over smaller ones.

    Minima are written before they are joined back, so that both sides of the join are
    plain and Spark can split a vertex with very many edges.
    """
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    near = edges.union(turned) if larger else turned
    least = kept(
        near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")), f"{purpose}-least"
    )
    tied = (edges if larger else turned).join(least, "a").select(F.col("least").alias("a"), "b")
    if not larger:
        tied = tied.union(least.select(F.col("least").alias("a"), F.col("a").alias("b")))
    return kept(tied.filter("a < b").distinct(), purpose)


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(vertex, component) for every end of an edge; the component is its least vertex.

    ``edges`` (a, b) may repeat and may name an edge in either direction; edges from a vertex to
    itself are left out, and so are NULLs. Passes over larger and over smaller neighbours take turns
    until every edge points from a least vertex to another member; their number grows with the logarithm
    of a component's size.
    Each pass is written, so a lost executor costs no more than the pass it was lost in.
    """
    current = kept(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a < b")
        .distinct(),
        purpose,
    )
    while True:
        # Stars only: no vertex stands on both sides, and none hangs on two centres.
        hung = current.groupBy("b").agg(F.count("*").alias("n"))
        again = hung.filter("n > 1").select("b").union(
            current.select("a").distinct().join(current.select(F.col("b").alias("a")), "a", "left_semi")
        )
        if again.isEmpty():
            break
        current = _tied(_tied(current, purpose, larger=True), purpose, larger=False)
    centres = current.select(F.col("a").alias("vertex"), F.col("a").alias("component")).distinct()
    return centres.union(current.select(F.col("b").alias("vertex"), F.col("a").alias("component")))
