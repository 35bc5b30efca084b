"""From pings to per-user-day trajectories cut where the user jumped.

``minute_dedup`` leaves at most one ping per user and minute, and ``process_day_expand`` at most
30 hours per process day. Every group after them therefore holds at most 1 800 rows, however many
pings one user sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellmap.functions.geo import haversine_m

ACCURACY_M = 70
ROAM_DIST_M = 70
OVERLAP_HOURS = 6
GRANULARITY_S = 60
USER_DAY = ["process_day", "userId"]


def accuracy_filter(pings: DataFrame, accuracy: float = ACCURACY_M) -> DataFrame:
    """Keep pings whose accuracy radius lies between 0 and ``accuracy`` metres."""
    return pings.where(F.col("accuracy").between(0, accuracy))


def personal_area_flag() -> Column:
    """True for pings marked as inside the user's personal area; null counts as false."""
    return F.coalesce(F.col("opt1") == "PERSONAL_AREA", F.lit(False)).alias("personal_area")


def select_ping_columns(pings: DataFrame) -> DataFrame:
    return pings.select(
        "userId", "timestamp", "latitude", "longitude", personal_area_flag(), "accuracy"
    )


def minute_dedup(pings: DataFrame, granularity_s: int = GRANULARITY_S) -> DataFrame:
    """The most accurate ping per user and minute; ties go to the earliest, then lowest position.

    The top-1 is also applied before the shuffle, so a minute with very many pings ships few rows.
    """
    seconds = F.unix_timestamp("timestamp")
    best = Window.partitionBy("userId", seconds - seconds % granularity_s).orderBy(
        "accuracy", "timestamp", "latitude", "longitude"
    )
    return pings.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank")


def process_day_expand(pings: DataFrame, overlap_hours: int = OVERLAP_HOURS) -> DataFrame:
    """Assign each ping to the day it belongs to, and early ones to the day before as well."""
    day = F.to_date("timestamp")
    days = F.when(
        F.hour("timestamp") < overlap_hours, F.array(day, F.date_sub(day, 1))
    ).otherwise(F.array(day))
    return pings.withColumn("process_day", F.explode(days))


def union_overlap(pings: DataFrame, overlap_hours: int = OVERLAP_HOURS) -> DataFrame:
    """The same assignment as a union of each day with the next day's early hours."""
    day = F.to_date("timestamp")
    today = pings.withColumn("process_day", day)
    early = pings.where(F.hour("timestamp") <= overlap_hours - 1)
    return today.unionByName(early.withColumn("process_day", F.date_sub(day, 1)))


def to_radians(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.radians(c) for c in ("latitude", "longitude")})


def to_degrees(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.degrees(c) for c in ("latitude", "longitude")})


def step_distance(pings: DataFrame) -> DataFrame:
    """Metres to the next and from the previous ping of the user-day; coordinates in radians.

    ``distance_next`` is null at the last ping, ``distance_prev`` is 0 at the first.
    """
    track = Window.partitionBy(*USER_DAY).orderBy("timestamp")
    onward = haversine_m(
        "latitude",
        "longitude",
        F.lead("latitude").over(track),
        F.lead("longitude").over(track),
    )
    return pings.withColumn("distance_next", onward).withColumn(
        "distance_prev", F.lag("distance_next", 1, 0.0).over(track)
    )


def chunks(steps: DataFrame, roam_dist: float = ROAM_DIST_M) -> DataFrame:
    """Number the stretches of a user-day between jumps longer than ``roam_dist``.

    ``chunk_start`` is the time of the stretch's first ping, taken from the same sorted window.
    """
    so_far = (
        Window.partitionBy(*USER_DAY)
        .orderBy("timestamp")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    jump = F.coalesce(F.col("distance_prev") > roam_dist, F.lit(False))
    return steps.withColumns(
        {
            "chunk": F.sum(F.when(jump, 1).otherwise(0)).over(so_far).cast("int"),
            "chunk_start": F.coalesce(
                F.max(F.when(jump, F.col("timestamp"))).over(so_far),
                F.min("timestamp").over(so_far),
            ),
        }
    )


def chunk_day_filter(chunked: DataFrame) -> DataFrame:
    """Keep the stretches that start on the process day; later ones belong to the next day."""
    return chunked.where(F.to_date("chunk_start") == F.col("process_day"))


def trajectories(chunked: DataFrame) -> DataFrame:
    """One row per stretch: its pings in time order and the metres travelled in it."""
    ping = F.struct("timestamp", "latitude", "longitude", "distance_prev", "personal_area")
    return chunked.groupBy(*USER_DAY, "chunk").agg(
        F.sort_array(F.collect_list(ping)).alias("gpsdata"),
        F.sum("distance_prev").alias("dist_sum"),
    )


def user_days(
    pings: DataFrame,
    accuracy: float = ACCURACY_M,
    overlap_hours: int = OVERLAP_HOURS,
    granularity_s: int = GRANULARITY_S,
) -> DataFrame:
    """Filtered, thinned pings per process day, coordinates in radians.

    Thinning comes before the expansion: a minute lies in one calendar day, so its best ping is
    the same for both process days and needs ranking only once. Other granularities must divide the
    overlap, so that no interval lies half inside it.
    """
    if 86_400 % granularity_s or overlap_hours * 3600 % granularity_s:
        raise ValueError(f"granularity_s={granularity_s} must divide a day and {overlap_hours} hours")
    kept = minute_dedup(select_ping_columns(accuracy_filter(pings, accuracy)), granularity_s)
    return to_radians(process_day_expand(kept.drop("accuracy"), overlap_hours))
