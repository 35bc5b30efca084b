"""Hand-made cases of stop detection and travelled distance."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dwellmap.checks import fixtures
from dwellmap.functions.geo import EARTH_RADIUS_M, haversine_np
from dwellmap.functions.tables import register_stop_function
from dwellmap.operators import stops, trajectory
from dwellmap.plans import mobility

DAY = dt.datetime(2024, 1, 10)
DEGREE_M = EARTH_RADIUS_M * np.pi / 180


def ping(at, north_m=0.0, user="aa01", opt1="OTHER", accuracy=10.0):
    hours, minutes, *seconds = (int(x) for x in at.split(":"))
    when = DAY + dt.timedelta(hours=hours, minutes=minutes, seconds=seconds[0] if seconds else 0)
    return (user, when, 40.0 + north_m / DEGREE_M, -75.0, float(accuracy), opt1)


def pings(spark, rows):
    return spark.createDataFrame(
        rows, "userId string, timestamp timestamp, latitude double, longitude double, accuracy double, opt1 string"
    )


def travelled(spark, rows, **options):
    found = stops.detect_stops(mobility.tracks(pings(spark, rows)), **options)
    return stops.travelled_distance(found).orderBy("userId", "begin").collect()


def clock(row, field="begin"):
    return row[field].strftime("%d %H:%M")


def test_one_ping_is_no_stop(spark):
    assert travelled(spark, [ping("10:00")]) == []


def test_stay_of_exactly_five_minutes_is_a_stop(spark):
    (stop,) = travelled(spark, [ping("10:00"), ping("10:05")])
    assert clock(stop) == "10 10:00" and clock(stop, "end") == "10 10:05"
    assert stop.prev_travelled_distance == 0 and stop.next_travelled_distance is None


def test_shorter_stay_is_not(spark):
    assert travelled(spark, [ping("10:00"), ping("10:04:59")]) == []


@pytest.mark.parametrize("width, expected", [(69.9, 1), (70.1, 0)])
def test_roaming_distance_is_the_diameter(spark, width, expected):
    rows = [ping("10:00"), ping("10:03", width / 2), ping("10:06", width)]
    assert len(travelled(spark, rows)) == expected


def test_stop_after_midnight_marks_the_one_before(spark):
    rows = [
        ping("23:40"), ping("23:50"), ping("23:55", 60), ping("24:01", 120),
        ping("24:10", 180), ping("24:20", 180),
    ]
    day = [r for r in travelled(spark, rows) if r.process_day == DAY.date()]
    assert [clock(r) for r in day] == ["10 23:40"]
    assert day[0].after_stop_distance == pytest.approx(0.1)
    assert day[0].next_travelled_distance == pytest.approx(0.1)


def test_stop_at_midnight_sharp_sets_no_mark(spark):
    rows = [ping("23:40"), ping("23:55", 60), ping("24:00", 120), ping("24:10", 180)]
    day = [r for r in travelled(spark, rows) if r.process_day == DAY.date()]
    assert [(clock(r), r.after_stop_distance) for r in day] == [("10 23:40", 0.0)]


def test_track_with_only_a_stop_after_midnight_is_left_to_the_next_day(spark):
    rows = [ping("23:58"), ping("24:02", 60), ping("24:06", 120), ping("24:10", 180), ping("24:20", 180)]
    found = travelled(spark, rows)
    assert {r.process_day for r in found} == {DAY.date() + dt.timedelta(days=1)}


def test_overlap_hours(spark):
    rows = [ping("29:59"), ping("30:00")]
    days = trajectory.process_day_expand(pings(spark, rows)).groupBy("process_day").count().collect()
    assert {r.process_day.day: r["count"] for r in days} == {11: 2, 10: 1}


def test_distance_of_moving_tracks_counts_before_and_after(spark):
    rows = [
        ping("09:00"), ping("09:01", 60), ping("09:02", 1060),
        ping("10:00", 5000), ping("10:06", 5000),
        ping("11:00", 9000),
    ]
    (stop,) = travelled(spark, rows)
    assert stop.prev_travelled_distance == pytest.approx(5000, abs=0.01)
    assert stop.next_travelled_distance == pytest.approx(4000, abs=0.01)


def test_best_ping_of_a_minute(spark):
    rows = [ping("10:00:10", 5, accuracy=30), ping("10:00:40", 9, accuracy=20), ping("10:01", 0, accuracy=70),
            ping("10:02", accuracy=70.5), ping("10:03", accuracy=-1)]
    kept = trajectory.minute_dedup(trajectory.accuracy_filter(pings(spark, rows))).orderBy("timestamp").collect()
    assert [(r.timestamp.minute, r.accuracy) for r in kept] == [(0, 20), (1, 70)]


def test_personal_area_is_false_when_unknown(spark):
    rows = [ping("10:00", opt1=None), ping("10:01", opt1="PERSONAL_AREA"), ping("10:02")]
    flags = trajectory.select_ping_columns(pings(spark, rows)).orderBy("timestamp").collect()
    assert [r.personal_area for r in flags] == [False, True, False]


def test_medoid_is_the_ping_nearest_to_the_others(spark):
    rows = [ping("10:00"), ping("10:02", 50), ping("10:04", 52), ping("10:06", 54)]
    (stop,) = travelled(spark, rows, center="medoid")
    assert (stop.latitude - 40) * DEGREE_M == pytest.approx(50, abs=0.01)
    (mean,) = travelled(spark, rows)
    assert (mean.latitude - 40) * DEGREE_M == pytest.approx(39, abs=0.01)


def test_distance_to_a_point(spark):
    (row,) = stops.distance_to_point(pings(spark, [ping("10:00", 100)]), 40.0, -75.0).collect()
    assert row.distance_m == pytest.approx(100)


def test_many_pings_of_one_user_in_a_minute_stay_one_row(spark):
    busy = spark.range(20_000).select(
        F.lit("aa01").alias("userId"),
        (F.lit(DAY) + F.make_dt_interval(secs=F.col("id") % 600)).alias("timestamp"),
        (F.lit(40.0) + F.col("id") * 1e-9).alias("latitude"),
        F.lit(-75.0).alias("longitude"),
        (F.col("id") % 70).cast("double").alias("accuracy"),
        F.lit("OTHER").alias("opt1"),
    )
    assert trajectory.user_days(busy).where(F.col("process_day") == DAY.date()).count() == 10
    assert mobility.tracks(busy).where(F.col("process_day") == DAY.date()).count() == 1


def brute_force(at, lat, lon, roam, stay):
    """Stops as index ranges, by measuring every run of pings anew."""

    def fits(i, j):
        a, b = np.triu_indices(j - i + 1, 1)
        return (haversine_np(lat[i + a], lon[i + a], lat[i + b], lon[i + b]) <= roam).all()

    runs, i = [], 0
    while i < len(at):
        later = np.flatnonzero(at >= at[i] + stay)
        if not len(later):
            break
        j = later[0]
        if fits(i, j):
            while j + 1 < len(at) and fits(i, j + 1):
                j += 1
            runs.append((at[i], at[j]))
            i = j + 1
        else:
            i += 1
    return runs


@pytest.mark.parametrize("seed", range(30))
def test_walk_agrees_with_brute_force(seed):
    rng = random.Random(seed)
    n = rng.choice([2, 5, 40, 200])
    step = rng.choice([0.5, 10, 40])
    at = np.cumsum([rng.randint(30, 400) * 1_000_000 for _ in range(n)])
    north = np.cumsum([rng.gauss(0, step) for _ in range(n)]) / EARTH_RADIUS_M
    lat, lon = np.radians(40) + north, np.full(n, np.radians(-75.0))
    track = [at, lat, lon, np.zeros(n), np.zeros(n, dtype=bool)]
    found = stops._walk(track, 10**18, 70.0, 300_000_000, True, False)
    assert [(s[3], s[4]) for s in found] == brute_force(at, lat, lon, 70.0, 300_000_000)


def scan(at, lat, lon, step, midnight):
    """Walked metres before and after each stop, ping by ping."""
    runs = brute_force(at, lat, lon, 70.0, 300_000_000)
    opens, found, walked, i = {a: b for a, b in runs}, [], 0.0, 0
    while i < len(at):
        if at[i] < midnight:
            walked += step[i]
        if not (at >= at[i] + 300_000_000).any():
            break
        if at[i] in opens:
            if found and at[i] > midnight:
                found[-1][1] += stops.KEEP_APART_M
                walked = 0.0
                break
            found.append([walked, 0.0])
            walked, i = 0.0, int(np.flatnonzero(at == opens[at[i]])[0])
        i += 1
    if found:
        found[-1][1] += walked
    return found


@pytest.mark.parametrize("seed", range(10))
def test_many_trajectories_at_once_agree_with_each_alone(seed):
    rng = np.random.default_rng(seed)
    tracks, midnights = [], []
    for _ in range(40):
        n = rng.choice([0, 1, 3, 12, 60])
        at = np.cumsum(rng.integers(30, rng.choice([90, 400]), n)) * 1_000_000
        north = rng.choice([rng.normal(0, 25, n), np.cumsum(rng.normal(0, 12, n))], axis=0) / EARTH_RADIUS_M
        tracks.append([at, 0.7 + north, np.full(n, -1.3), rng.random(n) * 30, rng.random(n) < 0.2])
        midnights.append(rng.integers(0, 6000) * 1_000_000)
    bounds = np.cumsum([0, *(len(t[0]) for t in tracks)])
    flat = [np.concatenate(columns) for columns in zip(*tracks)]
    counts, _, found = stops._walk_all(flat, bounds, np.array(midnights), 70.0, 300_000_000)
    rows = iter(zip(*(column.tolist() for column in found)))
    for track, midnight, count in zip(tracks, midnights, counts):
        at, lat, lon, step, personal = track
        got = [next(rows) for _ in range(count)]
        assert [list(row[6:]) for row in got] == scan(at, lat, lon, step, midnight)
        assert [row[0] for row in got] == list(range(count))
        assert [row[5] for row in got] == [personal[(at >= r[3]) & (at <= r[4])].any() for r in got]
    assert next(rows, None) is None


def test_result_does_not_depend_on_partitioning(spark):
    rows = [ping(f"{h}:{m:02d}", 30 * ((h * 60 + m) // 17), user=f"u{u}") for u in range(3) for h in (9, 10) for m in range(0, 60, 3)]
    one = travelled(spark, rows)
    frame = pings(spark, rows).repartition(7, "timestamp")
    other = stops.travelled_distance(stops.detect_stops(mobility.tracks(frame)))
    assert one == other.orderBy("userId", "begin").collect()


def test_table_function_finds_the_stops_of_detect_stops(spark):
    """Also when a trajectory reaches Python in several batches, and with other rules than the default."""
    pings = fixtures.pings(spark, "/root/testdata/sf0.001")
    steps = trajectory.step_distance(trajectory.user_days(pings))
    chunked = trajectory.chunk_day_filter(trajectory.chunks(steps))
    columns = ["process_day", "userId", "chunk", "serial", "latitude", "longitude", "distance", "dist_sum"]
    want = stops.detect_stops(trajectory.trajectories(chunked), roam_dist=120, min_stay=4).select(columns)
    register_stop_function(spark, "stops_of", roam_dist=120, min_stay=4)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = spark.sql(
            "SELECT * FROM stops_of(TABLE({pings}) PARTITION BY (process_day, userId, chunk) ORDER BY timestamp)",
            pings=chunked,
        ).select(columns).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = want.toPandas()
    order = columns[:4]
    pd.testing.assert_frame_equal(
        got.sort_values(order).reset_index(drop=True),
        want.sort_values(order).reset_index(drop=True),
        check_dtype=False, rtol=1e-9,
    )
    assert got["serial"].notna().any() and got["serial"].isna().any()


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_table_function_reads_many_trajectories_of_a_task(spark, batch):
    """One instance takes all trajectories of a task, however batches cut them."""
    pings = fixtures.pings(spark, "/root/testdata/sf0.001").where("hour(timestamp) < 9")
    chunked = trajectory.chunk_day_filter(trajectory.chunks(trajectory.step_distance(trajectory.user_days(pings))))
    columns = ["process_day", "userId", "chunk", "serial", "latitude", "longitude", "after_stop_distance", "dist_sum"]
    want = stops.detect_stops(trajectory.trajectories(chunked)).select(columns).toPandas()
    register_stop_function(spark)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = spark.sql(
            "SELECT * FROM detect_stops(TABLE(SELECT * FROM {pings} "
            "DISTRIBUTE BY process_day, userId SORT BY process_day, userId, chunk, timestamp))",
            pings=chunked,
        ).select(columns).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    order = columns[:4]
    pd.testing.assert_frame_equal(
        got.sort_values(order).reset_index(drop=True),
        want.sort_values(order).reset_index(drop=True),
        check_dtype=False, rtol=1e-9,
    )


@pytest.mark.parametrize("figure", [stops.stop_geometry, stops.stop_diameters])
def test_short_trajectories_do_not_go_to_python(spark, figure):
    tracks = spark.sql(
        "SELECT DATE'2024-01-01' AS process_day, 'u' AS userId, 0 AS chunk, transform(sequence(0, 3), n -> named_struct("
        "'timestamp', timestamp_seconds(1704067200 + n * 60), 'latitude', 0.7D, 'longitude', 1D, "
        "'distance_prev', 0D, 'personal_area', false)) AS gpsdata"
    )
    # Distances that Python could not add show whether it gets them.
    unread = tracks.withColumn("gpsdata", F.expr("transform(gpsdata, p -> struct(p.timestamp, p.latitude, p.longitude, 'x' AS distance_prev, p.personal_area))"))
    assert figure(unread).collect() == []
    assert figure(tracks, min_stay=3).count() == 1
