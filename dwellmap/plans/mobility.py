"""The stages chained: pings to stops, stops to places, and whole-history backfills."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmap.operators import clustering, merging, places, stops, trajectory
from dwellmap.session import discard, materialise
from dwellmap.sources import sinks
from dwellmap.sources.tables import scan_date_range


def tracks(
    pings: DataFrame,
    accuracy: float = trajectory.ACCURACY_M,
    roam_dist: float = trajectory.ROAM_DIST_M,
    overlap_hours: int = trajectory.OVERLAP_HOURS,
    granularity_s: int = trajectory.GRANULARITY_S,
) -> DataFrame:
    """Pings to trajectories, all users and process days at once."""
    steps = trajectory.step_distance(
        trajectory.user_days(pings, accuracy, overlap_hours, granularity_s)
    )
    chunked = trajectory.chunk_day_filter(trajectory.chunks(steps, roam_dist))
    return trajectory.trajectories(chunked)


def user_stops(
    pings: DataFrame,
    states: DataFrame,
    roam_dist: float = trajectory.ROAM_DIST_M,
    min_stay: float = stops.MIN_STAY_MIN,
    center: str = "mean",
    how: str = "inner",
    **track_options,
) -> DataFrame:
    """Pings to stops with travelled distances and state.

    Three shuffles: one to thin pings per user-minute; one by process day and user that serves the
    windows, the trajectory lists and the detection; and one of the far fewer detected stops, since
    Python evaluation does not keep track of the partitioning.
    """
    found = stops.detect_stops(
        tracks(pings, roam_dist=roam_dist, **track_options), roam_dist, min_stay, center
    )
    return stops.stops_with_state(
        stops.travelled_distance(found), stops.lookup_states(states), how
    )


def located_stops(
    stop_table: DataFrame,
    timezones: DataFrame,
    version: int = 6,
    eps_m: float = clustering.ROAM_DIST_STOPS_M,
    centroid_keys: tuple[str, ...] = places.CENTROID_KEYS,
    group_limit: int = clustering.GROUP_LIMIT,
    how: str = "inner",
    **rules,
) -> DataFrame:
    """Stops of all days to clustered stops with place centre and local offset.

    Version 6 merges across state borders and repairs overlaps; 5 merges within states; 3 also
    starts a group on any later day, and knows no time zones: it keeps a geohash-6 cell per stop.
    ``how="left"`` keeps places outside every time zone, without an offset. The clustered stops are
    written before they are located, as centres and stops are both made of them.
    """
    if version == 6:
        merged = merging.repair_overlaps(merging.merge_stops(stop_table, **rules))
    else:
        rules.setdefault("day_rule", "later" if version == 3 else "next")
        merged = merging.merge_stops(stop_table, by_state=True, **rules)
    clustered = materialise(clustering.cluster_places(merged, eps_m, group_limit))
    if version == 3:
        return places.located_v3(clustered)
    return places.local_offset(clustered, timezones, centroid_keys, how)


def write_visits_and_places(
    located: DataFrame,
    visits_path: str,
    places_path: str,
    country: str | None = None,
    visits_layout: str = "prefix",
) -> None:
    """Write both published tables from one computation, kept in the shared folder meanwhile.

    With ``country`` both tables are partitioned by country first.
    """
    kept = materialise(located)
    within = {"country": country} if country else {}
    sinks.write_visits(places.visits(kept), visits_path, visits_layout, within=within)
    sinks.write_places(places.places(kept), places_path, within=within)
    discard(kept)


def backfill(
    spark: SparkSession,
    pings_path: str,
    states: DataFrame,
    stops_path: str,
    start: dt.date,
    end: dt.date,
    by_prefix: bool = False,
    country: str | None = None,
    **options,
) -> None:
    """Detect and write the stops of every day from ``start`` to ``end`` in one job.

    Reads one day more for the overlap hours; partitions of other days are neither read nor touched.
    With ``country`` both tables are partitioned by country first. For very long histories call it
    month by month, which keeps each shuffle at a sensible size; days that are done can be found
    with ``sinks.pending_partitions``.
    """
    pings = scan_date_range(spark, pings_path, start, end + dt.timedelta(days=1))
    within = {"country": country} if country else {}
    if country:
        pings = pings.where(F.col("country") == country)
    found = user_stops(pings, states, **options).where(
        F.col("process_day").between(F.lit(start), F.lit(end))
    )
    sinks.write_stops(found, stops_path, by_prefix, within=within)
