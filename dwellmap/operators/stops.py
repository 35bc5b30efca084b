"""Stop detection on trajectories and the distance travelled between stops."""

from __future__ import annotations

import bisect
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellmap.functions.geo import Beyond, geohash, haversine_m, haversine_np
from dwellmap.functions.hull import diameter_m
from dwellmap.operators.trajectory import ROAM_DIST_M, USER_DAY, to_degrees

MIN_STAY_MIN = 5
# Metres added after a day's last stop when the next one starts past midnight, so that merging
# across days keeps them apart.
KEEP_APART_M = 0.1
# Candidate medoids closer than this (metres) count as equal; the earliest ping wins.
MEDOID_TIE_M = 1e-6

_TRACK_FIELDS = ("timestamp", "latitude", "longitude", "distance_prev", "personal_area")


def _flat(columns: list[pa.ListArray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Parallel list columns of an Arrow batch as flat arrays, and where each row's values begin and the last
    ends; a missing list counts as empty."""
    flat = []
    for column in columns:
        values = column.flatten()
        if pa.types.is_timestamp(values.type):
            values = values.cast(pa.int64())
        flat.append(values.to_numpy(zero_copy_only=False))
    sizes = columns[0].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def _blockers(lat: np.ndarray, lon: np.ndarray, first: np.ndarray, roam: float) -> np.ndarray:
    """Which runs of pings stay within the roaming distance: those from ``i`` to ``e`` with ``blockers[e] < i``.

    For every ping of many trajectories, one after another, the latest earlier ping that has a ping out of reach
    up to here; ``first`` is where a ping's trajectory begins. All pings are compared with the one before, then
    the one before that and so on, for as long as no blocker lies between.
    """
    blocker, beyond = first - 1, Beyond(lat, lon, roam)
    at = np.flatnonzero(np.arange(len(lat)) > first)
    back = 1
    while len(at):
        there = at - back
        far = beyond(there, at)
        blocker[at[far]] = there[far]
        at = at[~far]
        back += 1
        if back <= 16 or not back % 32:
            # Blockers of pings before stand for those after them; no trajectory sees another's, which lie lower.
            np.maximum.accumulate(blocker, out=blocker)
        at = at[at - back > blocker[at]]
    return np.maximum.accumulate(blocker)


def _medoid(lat: np.ndarray, lon: np.ndarray) -> tuple[int, float, float]:
    """Index of the ping nearest to all others, the sum over pairs, and the largest distance."""
    apart = haversine_np(lat[:, None], lon[:, None], lat[None, :], lon[None, :])
    totals = apart.sum(axis=1)
    return int(np.argmax(totals <= totals.min() + MEDOID_TIE_M)), float(apart.sum() / 2), float(apart.max())


def _walk_all(
    tracks: list[np.ndarray],
    bounds: np.ndarray,
    midnights: np.ndarray,
    roam: float,
    stay_us: int,
    daily: bool = True,
    medoid: bool = False,
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Stops of many trajectories, each scanned greedily in time order: the number of stops of each, the first
    ping of every stop and the one after its last, and the columns of ``_STOP_ARROW``.

    A stop opens at the first ping whose next ``stay`` minutes remain within ``roam`` and takes in
    all following pings for as long as the whole set does. With ``daily`` the distance walked
    between stops counts only before midnight, and a stop opening after midnight ends the scan.
    Python steps from stop to stop only; what concerns single pings is found for all trajectories at once.
    """
    at, lat, lon, step, personal = tracks
    starts, sizes = bounds[:-1], np.diff(bounds)
    counts = np.zeros(len(starts), dtype=np.int64)
    owner = np.repeat(np.arange(len(starts)), sizes)
    first, end = starts[owner], bounds[1:][owner]
    # Trajectories one after another on one time line, further apart than a stay.
    since = at - at[first] if len(at) else at
    spans = np.zeros(len(starts), dtype=np.int64)
    spans[sizes > 0] = since[bounds[1:][sizes > 0] - 1]
    line = since + (np.cumsum(spans + stay_us + 1) - (spans + stay_us + 1))[owner]
    until = np.searchsorted(line, line + stay_us, side="left")
    blocker = _blockers(lat, lon, first, roam)
    lasts = until < end
    opens = np.flatnonzero(lasts)
    opens = opens[blocker[until[opens]] < opens]
    # The scan ends at the first ping, after all stops, that less than a stay follows.
    scanned = starts + np.add.reduceat(np.append(lasts, False), starts) * (sizes > 0) if len(starts) else starts
    evening = at < midnights[owner] if daily else np.ones(len(at), bool)
    walks = np.where(evening, step, 0.0).tolist()
    late = (at > midnights[owner]).tolist() if daily else [False] * len(at)
    blocked, stays = blocker.tolist(), until.tolist()
    groups = np.flatnonzero(np.diff(owner[opens], prepend=-1))
    begins, ends, walked_before, walked_after = [], [], [], []
    opens_list = opens.tolist()
    for lo, hi in zip(groups.tolist(), [*groups[1:].tolist(), len(opens_list)]):
        track = int(owner[opens_list[lo]])
        i, limit, n_before = int(starts[track]), int(bounds[track + 1]), len(begins)
        while True:
            lo = bisect.bisect_left(opens_list, i, lo, hi)
            opened = lo < hi
            stop = opens_list[lo] + 1 if opened else min(max(int(scanned[track]), i) + 1, limit)
            walked = 0.0
            for metres in walks[i:stop]:
                walked += metres
            if not opened:
                break
            i = opens_list[lo]
            if late[i] and len(begins) > n_before:
                walked_after[-1] += KEEP_APART_M
                walked = 0.0
                break
            begins.append(i)
            i = bisect.bisect_left(blocked, i, stays[i] + 1, limit)
            ends.append(i)
            walked_before.append(walked)
            walked_after.append(0.0)
        if daily:
            walked_after[-1] += walked
        counts[track] = len(begins) - n_before
    begin, after = np.array(begins, dtype=np.int64), np.array(ends, dtype=np.int64)
    if medoid:
        centre = [b + _medoid(lat[b:e], lon[b:e])[0] for b, e in zip(begins, ends)]
        position = [values[np.array(centre, dtype=np.int64)] for values in (lat, lon)]
    else:
        position = [
            np.array([np.add.reduce(values[b:e]) / (e - b) for b, e in zip(begins, ends)], dtype=np.float64)
            for values in (lat, lon)
        ]
    marked = np.concatenate([[0], np.cumsum(personal.astype(bool))])
    serial = np.arange(len(begins)) - np.repeat(np.cumsum(counts) - counts, counts)
    found = [
        serial.astype(np.int32),
        *position,
        at[begin],
        at[after - 1],
        marked[after] > marked[begin],
        np.array(walked_before, dtype=np.float64),
        np.array(walked_after, dtype=np.float64),
    ]
    return counts, np.stack([begin, after]), found


def _walk(track, midnight: int, roam: float, stay_us: int, daily: bool, medoid: bool) -> list[tuple]:
    """Stops of one trajectory."""
    bounds = np.array([0, len(track[0])])
    found = _walk_all(track, bounds, np.array([midnight]), roam, stay_us, daily, medoid)[2]
    return list(zip(*(column.tolist() for column in found)))


_STOP_TYPE = (
    "array<struct<serial:int,latitude:double,longitude:double,begin_us:bigint,end_us:bigint,"
    "personal_area:boolean,distance:double,after_stop_distance:double>>"
)
_STOP_ARROW = pa.struct(
    [
        ("serial", pa.int32()),
        ("latitude", pa.float64()),
        ("longitude", pa.float64()),
        ("begin_us", pa.int64()),
        ("end_us", pa.int64()),
        ("personal_area", pa.bool_()),
        ("distance", pa.float64()),
        ("after_stop_distance", pa.float64()),
    ]
)


def _list_of_structs(counts: np.ndarray, columns: list, struct: pa.StructType) -> pa.ListArray:
    """Arrow list column with the next so many structs for each row."""
    fields = [pa.array(values, type=field.type) for values, field in zip(columns, struct, strict=True)]
    values = pa.StructArray.from_arrays(fields, fields=list(struct))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _stop_finder(roam: float, stay_us: int, daily: bool, medoid: bool) -> Callable[..., Column]:
    @F.arrow_udf(_STOP_TYPE)
    def find(
        at: pa.Array, lat: pa.Array, lon: pa.Array, step: pa.Array, personal: pa.Array, midnight: pa.Array
    ) -> pa.Array:
        tracks, bounds = _flat([at, lat, lon, step, personal])
        days = midnight.to_numpy(zero_copy_only=False)
        counts, _, found = _walk_all(tracks, bounds, days, roam, stay_us, daily, medoid)
        return _list_of_structs(counts, found, _STOP_ARROW)

    return find


def _next_midnight_us() -> Column:
    return F.unix_micros(F.date_add("process_day", 1).cast("timestamp"))


def _may_stop(stay_us: int) -> Column:
    """Whether a trajectory lasts long enough to hold a stop; the others need not go to Python."""
    lasts = F.unix_micros(F.expr("gpsdata[size(gpsdata) - 1].timestamp")) - F.unix_micros(
        F.expr("gpsdata[0].timestamp")
    )
    return (F.size("gpsdata") >= 2) & (lasts >= stay_us)


def detect_stops(
    tracks: DataFrame,
    roam_dist: float = ROAM_DIST_M,
    min_stay: float = MIN_STAY_MIN,
    center: str = "mean",
    daily: bool = True,
) -> DataFrame:
    """Stops of every trajectory, coordinates in radians.

    A trajectory without stops stays as one row with null stop columns, as its distance counts
    towards the neighbouring stops. Only trajectories that last ``min_stay`` go to Python, as Arrow
    lists.
    """
    stay_us = int(min_stay * 60_000_000)
    candidate = F.when(_may_stop(stay_us), F.col("gpsdata"))
    find = _stop_finder(float(roam_dist), stay_us, daily, center == "medoid")
    found = find(*[candidate[f] for f in _TRACK_FIELDS], _next_midnight_us())
    stop = F.col("stop")
    return (
        tracks.withColumn("stops", found)
        .select(*USER_DAY, "chunk", "dist_sum", F.explode_outer("stops").alias("stop"))
        .select(
            *USER_DAY,
            "chunk",
            stop["serial"].alias("serial"),
            stop["latitude"].alias("latitude"),
            stop["longitude"].alias("longitude"),
            F.timestamp_micros(stop["begin_us"]).alias("begin"),
            F.timestamp_micros(stop["end_us"]).alias("end"),
            stop["personal_area"].alias("personal_area"),
            stop["distance"].alias("distance"),
            geohash("degrees(stop.latitude)", "degrees(stop.longitude)", 6).alias("geohash6"),
            stop["after_stop_distance"].alias("after_stop_distance"),
            "dist_sum",
        )
    )


_GEOMETRY_TYPE = (
    "array<struct<serial:int,n_points:int,n_pairs:bigint,pair_sum_m:double,diameter_m:double,"
    "medoid_lat:double,medoid_lon:double>>"
)
_GEOMETRY_ARROW = pa.struct(
    [
        ("serial", pa.int32()),
        ("n_points", pa.int32()),
        ("n_pairs", pa.int64()),
        ("pair_sum_m", pa.float64()),
        ("diameter_m", pa.float64()),
        ("medoid_lat", pa.float64()),
        ("medoid_lon", pa.float64()),
    ]
)


def stop_geometry(
    tracks: DataFrame, roam_dist: float = ROAM_DIST_M, min_stay: float = MIN_STAY_MIN
) -> DataFrame:
    """Pairwise-distance figures of each stop's pings: pair count and sum, diameter and medoid.

    Distances are summarised where the pings already sit together (at most 1 800 of them); the
    pairs themselves are never emitted as rows.
    """
    stay_us = int(min_stay * 60_000_000)

    @F.arrow_udf(_GEOMETRY_TYPE)
    def measure(
        at: pa.Array, lat: pa.Array, lon: pa.Array, step: pa.Array, personal: pa.Array, midnight: pa.Array
    ) -> pa.Array:
        tracks, bounds = _flat([at, lat, lon, step, personal])
        days = midnight.to_numpy(zero_copy_only=False)
        counts, members, (serial, *_) = _walk_all(tracks, bounds, days, roam_dist, stay_us)
        rows = []
        for begin, after in members.T.tolist():
            la, lo = tracks[1][begin:after], tracks[2][begin:after]
            medoid, total, widest = _medoid(la, lo)
            n = len(la)
            rows.append((n, n * (n - 1) // 2, total, widest, la[medoid], lo[medoid]))
        columns = list(zip(*rows)) or [()] * (len(_GEOMETRY_ARROW) - 1)
        return _list_of_structs(counts, [serial, *columns], _GEOMETRY_ARROW)

    gps = F.col("gpsdata")
    return (
        tracks.where(_may_stop(stay_us))
        .withColumn("stops", measure(*[gps[f] for f in _TRACK_FIELDS], _next_midnight_us()))
        .select(*USER_DAY, "chunk", F.inline("stops"))
        .withColumns({c: F.degrees(c) for c in ("medoid_lat", "medoid_lon")})
    )


def stop_diameters(
    tracks: DataFrame, roam_dist: float = ROAM_DIST_M, min_stay: float = MIN_STAY_MIN
) -> DataFrame:
    """Largest distance between two pings of each stop, by the hull of its pings: no pairs are compared."""
    stay_us = int(min_stay * 60_000_000)

    @F.arrow_udf("array<struct<serial:int,diameter_m:double>>")
    def measure(
        at: pa.Array, lat: pa.Array, lon: pa.Array, step: pa.Array, personal: pa.Array, midnight: pa.Array
    ) -> pa.Array:
        tracks, bounds = _flat([at, lat, lon, step, personal])
        days = midnight.to_numpy(zero_copy_only=False)
        counts, members, (serial, *_) = _walk_all(tracks, bounds, days, roam_dist, stay_us)
        widest = [diameter_m(tracks[1][begin:after], tracks[2][begin:after]) for begin, after in members.T.tolist()]
        return _list_of_structs(
            counts, [serial, widest], pa.struct([("serial", pa.int32()), ("diameter_m", pa.float64())])
        )

    gps = F.col("gpsdata")
    return (
        tracks.where(_may_stop(stay_us))
        .withColumn("stops", measure(*[gps[f] for f in _TRACK_FIELDS], _next_midnight_us()))
        .select(*USER_DAY, "chunk", F.inline("stops"))
    )


def distance_to_point(df: DataFrame, latitude: float, longitude: float) -> DataFrame:
    """Metres from every row's position to one point, all in degrees."""
    there = (F.radians(F.lit(float(latitude))), F.radians(F.lit(float(longitude))))
    return df.withColumn(
        "distance_m", haversine_m(F.radians("latitude"), F.radians("longitude"), *there)
    )


def travelled_distance(detected: DataFrame) -> DataFrame:
    """One row per stop with the metres travelled before and after it, coordinates in degrees.

    Stops that begin after midnight are left to the next process day. The distance of stopless
    trajectories is added to the stop that follows them.
    """
    kept = detected.fillna(0.0, ["after_stop_distance"]).where(
        F.col("begin").isNull() | (F.to_date("begin") != F.date_add("process_day", 1))
    )
    is_stop = F.col("serial").isNotNull()
    to_end = (
        Window.partitionBy(*USER_DAY)
        .orderBy("chunk", "serial")
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    # Stops still to come, this one included: a stop and the trajectories leading to it share it.
    numbered = kept.withColumns(
        {
            "stops_left": F.sum(F.when(is_stop, 1).otherwise(0)).over(to_end),
            "metres": F.when(is_stop, F.col("distance")).otherwise(F.col("dist_sum")),
        }
    )
    # Fixed-width columns only, so this stays a hash aggregate; the geohash is worked out after it.
    only = ("latitude", "longitude", "begin", "end", "personal_area")
    legs = numbered.groupBy(*USER_DAY, "stops_left").agg(
        *[F.max(c).alias(c) for c in only],
        F.sum("metres").alias("prev_travelled_distance"),
        F.sum("after_stop_distance").alias("after_stop_distance"),
    )
    onward = F.lead("prev_travelled_distance").over(
        Window.partitionBy(*USER_DAY).orderBy(F.desc("stops_left"))
    )
    after = F.when(F.col("after_stop_distance") > 0, F.col("after_stop_distance"))
    with_next = legs.withColumn("next_travelled_distance", F.coalesce(onward, after))
    found = to_degrees(with_next.dropna(subset=["latitude"]))
    return found.select(
        *USER_DAY,
        *only,
        geohash("latitude", "longitude", 6).alias("geohash6"),
        "prev_travelled_distance",
        "after_stop_distance",
        "next_travelled_distance",
    )


def lookup_states(lookup: DataFrame) -> DataFrame:
    """Geohash-5 to state, one row per cell."""
    return lookup.groupBy(F.col("geohash").alias("geohash5")).agg(F.min("STUSPS").alias("state"))


def stops_with_state(stops: DataFrame, states: DataFrame, how: str = "inner") -> DataFrame:
    """Attach the state of each stop's cell; by default stops outside every state are dropped.

    No broadcast hint: Spark broadcasts the lookup while it is below the size threshold and falls
    back to a shuffle join, with skew handling, beyond it.
    """
    # Never null, so that no null check repeats the geohash expression below the join.
    cell = F.coalesce(F.substring("geohash6", 1, 5), F.lit(""))
    return stops.withColumn("geohash5", cell).join(states, "geohash5", how).drop("geohash5")
