"""Merging a user's stops across days and repairing overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmap.functions.geo import haversine_m
from dwellmap.functions.timeline import (
    SPAN,
    by_span,
    with_neighbour,
    with_neighbour_together,
    with_running_total,
    with_running_total_together,
)
from dwellmap.operators.stops import MIN_STAY_MIN
from dwellmap.session import materialise

ROAM_DIST_EVENTS_M = 70
NIGHT_HOUR = 6
USER = ["userId"]
STOP_ORDER = ["begin", "end", "latitude", "longitude"]
_MERGE_INPUT = [
    "userId",
    "state",
    *STOP_ORDER,
    "prev_travelled_distance",
    "next_travelled_distance",
]


def _new_day(rule: str) -> Column:
    """Whether a stop begins on a later day than the previous one ended.

    ``next`` and ``later`` compare days of the year, as the published tables do, and so miss the
    turn of the year; ``date`` compares calendar dates.
    """
    if rule == "date":
        return F.datediff("begin", "previous.end") == 1
    gap = F.dayofyear("begin") - F.dayofyear("previous.end")
    if rule == "next":
        return gap == 1
    if rule == "later":
        return gap > 0
    raise ValueError(f"unknown day rule {rule!r}")


def merge_flag(
    stops: DataFrame,
    roam_dist: float = ROAM_DIST_EVENTS_M,
    day_rule: str = "next",
    night_hour: int = NIGHT_HOUR,
    together: bool = False,
) -> DataFrame:
    """Mark with 1 the stops that open a new group: the user moved, or a new day began at night.

    A stop that overlaps the previous one never opens a group. Nulls count as "not known to have
    moved", so a user's first stop is marked only if distance was travelled before it.
    """
    known = stops.select(*_MERGE_INPUT).fillna(0.0, ["next_travelled_distance"])
    if together:
        seen = with_neighbour_together(known, USER, STOP_ORDER, "previous")
    else:
        seen = with_neighbour(by_span(known, USER, "begin"), USER, STOP_ORDER, "previous")
    here = [F.radians(c) for c in ("latitude", "longitude")]
    there = [F.radians(F.col(f"previous.{c}")) for c in ("latitude", "longitude")]
    jump = F.coalesce(haversine_m(*there, *here), F.lit(0.0))
    before, onward = F.col("prev_travelled_distance"), F.col("previous.next_travelled_distance")
    moved = (
        (onward != before)
        | (before > 0)
        | (onward > 0)
        | (jump > roam_dist)
        | (_new_day(day_rule) & (F.hour("begin") < night_hour))
    )
    apart = F.col("previous.end").isNull() | (F.col("previous.end") < F.col("begin"))
    return seen.withColumns(
        {"distance_prev": jump, "opens_group": F.when(moved & apart, 1).otherwise(0)}
    ).drop("previous")


def merge_stops(
    stops: DataFrame, by_state: bool = False, together: bool = False, **rules
) -> DataFrame:
    """One row per group of stops at which the user stayed put.

    ``by_state`` splits groups at state borders, as earlier versions of the tables did. With ``together``
    (see ``merge_flag``) rows don't move and nothing is written in between.
    """
    if together:
        flagged = merge_flag(stops, together=True, **rules)
        grouped = with_running_total_together(flagged, USER, ["begin"], F.col("opens_group"), "group")
    else:
        # Written, as the running total reads the flags twice: the windows before it run once.
        flagged = materialise(merge_flag(stops, **rules)).repartition(*USER, SPAN)
        grouped = with_running_total(flagged, USER, ["begin"], F.col("opens_group"), "group")
    first_state = F.min_by("state", F.struct("begin", "end", "latitude", "longitude", "state"))
    states = [] if by_state else [first_state.alias("state")]
    return (
        grouped.groupBy(*USER, "group", *(["state"] if by_state else []))
        .agg(
            F.avg("latitude").alias("latitude"),
            F.avg("longitude").alias("longitude"),
            F.min("begin").alias("begin"),
            F.max("end").alias("end"),
            *states,
        )
        .select("userId", "state", "latitude", "longitude", "begin", "end")
    )


def repair_overlaps(
    merged: DataFrame, min_stay: float = MIN_STAY_MIN, together: bool = False
) -> DataFrame:
    """End a stop ``min_stay`` before the next one begins when the two overlap.

    Left alone when the next stop begins within twice ``min_stay``, as no room would remain.
    """
    gap = int(min_stay * 60)
    if together:
        ahead = with_neighbour_together(merged, USER, STOP_ORDER, "following", following=True)
    else:
        spans = by_span(merged, USER, "begin")
        ahead = with_neighbour(spans, USER, STOP_ORDER, "following", following=True)
    begins = F.col("following.begin")
    roomy = F.unix_seconds(begins) - F.unix_seconds("begin") > 2 * gap
    cut = begins - F.make_dt_interval(secs=F.lit(gap))
    return ahead.withColumn(
        "end", F.when(roomy & (begins < F.col("end")), cut).otherwise(F.col("end"))
    ).drop("following", SPAN)
