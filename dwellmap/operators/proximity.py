"""Points of one set near points of another, as an equality join on grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmap.functions.geo import EARTH_RADIUS_M, haversine_m

#: Points of the searched set in one part of a cell; fuller cells are split.
CELL_LIMIT = 4096
# Cells are a little larger than the radius, so that rounding cannot push a neighbour two cells away.
_CELL_GROWTH = 1.001
_ON_GLOBE = "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -360 AND 360"


def _columns_of(row: Column, side: float) -> Column:
    """Number of columns in a row of cells.

    A column is at least as wide as the largest difference in longitude of two points that are one side
    apart and lie in this row or the next ones; near the poles a row is a single column.
    """
    farthest = F.greatest(F.abs(row - 1), F.abs(row + 2)) * F.lit(side)
    ratio = F.lit(math.sin(side / 2)) / F.cos(F.least(farthest, F.lit(math.pi / 2)))
    reach = 2 * F.asin(F.least(ratio, F.lit(1.0)))
    wide = (farthest < math.pi / 2) & (ratio < 1)
    return F.when(wide, F.greatest(F.floor(2 * math.pi / reach), F.lit(1))).otherwise(1).cast("long")


def _column(lon: Column, count: Column) -> Column:
    turn = F.pmod(lon + math.pi, F.lit(2 * math.pi)) / (2 * math.pi)
    return F.least(F.floor(turn * count), count - 1)


def _points(df: DataFrame, key: str, name: str) -> DataFrame:
    """Key and position in radians of the rows that have a position on the globe."""
    return df.where(_ON_GLOBE).select(
        F.col(key).alias(name), F.radians("latitude").alias("lat"), F.radians("longitude").alias("lon")
    )


def near_points(
    points: DataFrame, others: DataFrame, radius_m: float, key: str, other_key: str,
    cell_limit: int = CELL_LIMIT,
) -> DataFrame:
    """One row per key of ``points``: ``n_near``, how many of ``others`` lie within ``radius_m`` of it, and the
    nearest of these, ``nearest`` with ``nearest_m`` metres. Positions are ``latitude`` and ``longitude`` in
    degrees; every row of both sets counts.

    The globe is cut into cells at least as wide as the radius. A point of ``others`` stands in one cell, a
    point of ``points`` looks into the at most nine around it, so the join is one on equal cells; cells
    without others drop out before. A cell with more than ``cell_limit`` others is dealt to parts, each
    looked into. Points at one position are one spot on both sides, so the pairs compared are those of different
    spots, however many points share them. They are counted where they are found, and only counts move on.

    Nearness is judged to the millimetre, and of equally near ones the smallest key counts. A point without
    a position, or with none near, has ``n_near`` 0 and no nearest.
    """
    side = radius_m / EARTH_RADIUS_M * _CELL_GROWTH
    row = F.col("row")
    there = (
        _points(others, other_key, "other").groupBy("lat", "lon")
        .agg(F.count("*").alias("here"), F.min("other").alias("other"))
        .withColumn("row", F.floor(F.col("lat") / side))
    )
    there = there.withColumn("col", _column(F.col("lon"), _columns_of(row, side)))
    parts = (
        there.groupBy("row", "col").agg(F.count("*").alias("n"))
        .select("row", "col", F.ceil(F.col("n") / cell_limit).alias("parts"))
    )
    dealt = there.join(parts.where("parts > 1"), ["row", "col"], "left").withColumn(
        "part", F.pmod(F.xxhash64("lat", "lon"), F.coalesce("parts", F.lit(1)))
    )
    placed = _points(points, key, "point")
    looked = placed.select("lat", "lon").distinct().withColumn(
        "row", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.floor(F.col("lat") / side) + d))
    )
    count = _columns_of(row, side)
    around = F.transform(
        F.sequence(F.lit(-1), F.lit(1)), lambda d: F.pmod(_column(F.col("lon"), count) + d, count)
    )
    looked = (
        looked.withColumn("col", F.explode(F.array_distinct(around)))
        .join(parts, ["row", "col"])
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    )
    apart = haversine_m("a.lat", "a.lon", "b.lat", "b.lon")
    found = (
        looked.alias("a")
        .join(dealt.alias("b"), ["row", "col", "part"])
        .select("a.lat", "a.lon", "here", "other", apart.alias("apart"))
        .where(F.col("apart") <= radius_m)
        .groupBy("lat", "lon")
        .agg(F.sum("here").alias("hits"), F.min(F.struct(F.round("apart", 3).alias("m"), "other")).alias("near"))
    )
    # Points without a position take part as rows without a hit, so the result needs no join back by key.
    none = points.where(f"NOT coalesce({_ON_GLOBE}, false)").select(
        F.col(key).alias("point"), *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("hits", "near")]
    )
    return (
        placed.join(found, ["lat", "lon"], "left")
        .select("point", "hits", "near")
        .unionByName(none)
        .groupBy("point")
        .agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("n_near"), F.min("near").alias("near"))
        .select(
            F.col("point").alias(key),
            "n_near",
            F.col("near.other").alias("nearest"),
            F.col("near.m").alias("nearest_m"),
        )
    )
