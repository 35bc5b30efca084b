"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmap.session import discard, materialise


def connected_components(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest vertex reachable from each vertex ``u`` of undirected edges (u, v), per ``keys``.

    Alternates two steps until nothing changes: every vertex hands its larger neighbours, then its
    smaller ones, to the smallest vertex it knows. Each ends as a star around the smallest vertex,
    after a number of rounds that grows with the logarithm of the component, not its diameter.
    Only minima are aggregated, so a vertex with very many neighbours is never collected. The minima
    are written before they are joined: the join then has a shuffle on both sides, and adaptive
    execution can split the edges of a hot vertex over many tasks. Tables of a finished round are
    deleted.
    """
    edge = [*keys, "u"]

    def known(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        least = materialise(pairs.groupBy(*edge).agg(F.min("v").alias("m")))
        return least, pairs.join(least, edge).withColumn("m", F.least("m", "u"))

    stars = materialise(
        edges.select(*keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v")
        .distinct()
    )
    while True:
        both = stars.union(stars.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        first, seen = known(both)
        large = materialise(
            seen.where("v > u").select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        second, seen = known(large)
        handed = seen.where("v <> m").select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        turned = materialise(
            handed.union(seen.select(*keys, "u", F.col("m").alias("v"))).distinct()
        )
        discard(stars, first, large, second)
        # Settled when no vertex is both a centre and attached to another one, or attached twice.
        centres = turned.select(*keys, F.col("v").alias("u")).distinct()
        settled = not turned.join(centres, edge, "left_semi").take(1)
        repeated = turned.groupBy(*edge).count().where("count > 1")
        stars = turned
        if settled and not repeated.take(1):
            return stars.select(*edge, F.col("v").alias("component"))
