"""Places and visits: cluster centres, local time, and the two published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmap.functions.geo import geohash

CENTROID_KEYS = ("userId", "clusterId")


def cluster_centroids(
    clustered: DataFrame, centroid_keys: tuple[str, ...] = CENTROID_KEYS
) -> DataFrame:
    """Mean position of each place.

    The default keys leave out the state, so places with the same number in two states of one user
    share a centre, as in the published tables; add ``state`` to keep them apart.
    """
    return clustered.groupBy(*centroid_keys).agg(
        F.avg("latitude").alias("clusterLatitude"), F.avg("longitude").alias("clusterLongitude")
    )


def hour_offset(at: Column | str, tzid: Column | str) -> Column:
    """Whole hours local time is ahead of UTC at an instant, cut off towards zero."""
    local = F.from_utc_timestamp(at, F.col(tzid) if isinstance(tzid, str) else tzid)
    return ((F.unix_timestamp(local) - F.unix_timestamp(at)) / 3600).cast("int")


def local_offset(
    clustered: DataFrame,
    timezones: DataFrame,
    centroid_keys: tuple[str, ...] = CENTROID_KEYS,
    how: str = "inner",
) -> DataFrame:
    """Clustered stops with place centre, geohash and local hour offset.

    Centres, geohashes and time zones are worked out per place, before the join back to the stops,
    so the lookup meets far fewer rows. Places outside every time zone are dropped by default.
    """
    located = (
        cluster_centroids(clustered, centroid_keys)
        .withColumn("geohash7", geohash("clusterLatitude", "clusterLongitude", 7))
        .withColumn("geohash5", F.coalesce(F.substring("geohash7", 1, 5), F.lit("")))
        .join(timezones, "geohash5", how)
        .drop("geohash5")
    )
    return (
        clustered.drop("latitude", "longitude")
        .join(located, list(centroid_keys))
        .withColumns(
            {
                "prefix": F.substring("userId", 1, 2),
                "year": F.year("begin"),
                "dayofyear": F.dayofyear("begin"),
                "offset": hour_offset("begin", "tzid"),
            }
        )
    )


def located_v3(clustered: DataFrame) -> DataFrame:
    """Clustered stops as the earliest tables kept them: geohash-6 cell, no time zones, no stop lost."""
    return clustered.withColumns(
        {
            "prefix": F.substring("userId", 1, 2),
            "geohash6": geohash("latitude", "longitude", 6),
            "year": F.year("begin"),
            "dayofyear": F.dayofyear("begin"),
        }
    )


_VISIT = ("prefix", "userId", "clusterId", "begin", "end", "offset", "year", "dayofyear")


def visits(located: DataFrame) -> DataFrame:
    """One row per stop: which place, from when to when, and the local hour offset where it is known
    (the earliest tables have none)."""
    return located.select([c for c in _VISIT if c in located.columns])


_PLACE = ["prefix", "userId", "clusterId", "clusterLatitude", "clusterLongitude", "geohash7"]


def places(located: DataFrame) -> DataFrame:
    """One row per place; one that spans states gets the alphabetically first."""
    return located.groupBy(*_PLACE).agg(F.min("state").alias("state"))


def places_distinct(located: DataFrame) -> DataFrame:
    """One row per place and state, as earlier versions of the table kept them."""
    return located.select(*_PLACE, "state").distinct()


def places_by_year(clustered: DataFrame) -> DataFrame:
    """Places per year with the geohash-6 cells of their stops, as the earliest tables kept them."""
    return (
        located_v3(clustered)
        .select("prefix", "userId", "clusterId", "geohash6", "year")
        .distinct()
        .join(cluster_centroids(clustered), list(CENTROID_KEYS))
    )
