"""Merging stops across days, and neighbours along the time line."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dwellmap.functions.timeline import by_span, with_neighbour, with_running_total
from dwellmap.operators import merging, places
from dwellmap.plans import mobility

STOPS = (
    "userId string, state string, latitude double, longitude double, begin timestamp, end timestamp, "
    "prev_travelled_distance double, next_travelled_distance double"
)


def stop(begin, end, lat=40.0, prev=0.0, nxt=0.0, user="aa01", state="NY"):
    return (user, state, lat, -75.0, dt.datetime.fromisoformat(begin), dt.datetime.fromisoformat(end), prev, nxt)


def merged(spark, rows, **rules):
    return merging.merge_stops(spark.createDataFrame(rows, STOPS), **rules).orderBy("begin").collect()


def repaired(spark, *rows):
    frame = spark.createDataFrame(rows, STOPS)
    return merging.repair_overlaps(frame.select("userId", "state", "latitude", "longitude", "begin", "end")).orderBy(
        "begin"
    ).collect()


def test_stops_at_one_spot_merge(spark):
    (row,) = merged(spark, [stop("2024-01-10 10:00", "2024-01-10 11:00"),
                            stop("2024-01-10 12:00", "2024-01-10 13:00", lat=40.0001)])
    assert row.latitude == pytest.approx(40.00005)
    assert (row.begin.hour, row.end.hour) == (10, 13)


def test_unknown_next_distance_counts_as_none(spark):
    rows = [stop("2024-01-10 10:00", "2024-01-10 11:00", nxt=None), stop("2024-01-10 12:00", "2024-01-10 13:00")]
    assert len(merged(spark, rows)) == 1


@pytest.mark.parametrize("change", [{"prev": 5.0}, {"lat": 40.001}])
def test_moving_starts_a_new_group(spark, change):
    rows = [stop("2024-01-10 10:00", "2024-01-10 11:00"), stop("2024-01-10 12:00", "2024-01-10 13:00", **change)]
    assert len(merged(spark, rows)) == 2


def test_overlap_never_starts_a_group(spark):
    rows = [stop("2024-01-10 10:00", "2024-01-10 13:00"), stop("2024-01-10 12:00", "2024-01-10 14:00", prev=9.0)]
    assert len(merged(spark, rows)) == 1


@pytest.mark.parametrize(
    "begin, rule, groups",
    [
        ("2024-01-11 05:00", "next", 2), ("2024-01-11 06:00", "next", 1), ("2024-01-13 05:00", "next", 1),
        ("2024-01-13 05:00", "later", 2), ("2024-01-11 05:00", "date", 2),
    ],
)
def test_day_rules(spark, begin, rule, groups):
    rows = [stop("2024-01-10 10:00", "2024-01-10 23:00"), stop(begin, begin[:11] + "09:00")]
    assert len(merged(spark, rows, day_rule=rule)) == groups


def test_new_year(spark):
    rows = [stop("2023-12-31 10:00", "2023-12-31 23:00"), stop("2024-01-01 05:00", "2024-01-01 09:00")]
    assert len(merged(spark, rows)) == 1
    assert len(merged(spark, rows, day_rule="date")) == 2


def test_groups_can_split_at_state_borders(spark):
    rows = [stop("2024-01-10 10:00", "2024-01-10 11:00"), stop("2024-01-10 12:00", "2024-01-10 13:00", state="NJ")]
    assert [r.state for r in merged(spark, rows)] == ["NY"]
    assert [r.state for r in merged(spark, rows, by_state=True)] == ["NY", "NJ"]


def test_unknown_day_rule(spark):
    with pytest.raises(ValueError):
        merged(spark, [stop("2024-01-10 10:00", "2024-01-10 11:00")], day_rule="weekly")


def test_overlap_is_cut_five_minutes_before_the_next(spark):
    first, _ = repaired(spark, stop("2024-01-10 10:00", "2024-01-10 10:40"), stop("2024-01-10 10:20", "2024-01-10 11:00"))
    assert first.end == dt.datetime(2024, 1, 10, 10, 15)


def test_overlap_without_room_stays(spark):
    first, _ = repaired(spark, stop("2024-01-10 10:00", "2024-01-10 10:40"), stop("2024-01-10 10:08", "2024-01-10 11:00"))
    assert first.end == dt.datetime(2024, 1, 10, 10, 40)


def test_time_line_equals_plain_windows(spark):
    """Spans with gaps, a hot user and ties give what one window per user gives."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 40)).alias("userId"),
        F.timestamp_seconds((F.xxhash64("id") % 10_000_000) + 1_700_000_000).alias("begin"),
        "id",
    )
    spans = by_span(rows, ["userId"], "begin", days=3)
    order = ["begin", "id"]
    got = with_neighbour(spans, ["userId"], order, "before")
    got = with_neighbour(got, ["userId"], order, "after", following=True)
    got = with_running_total(got, ["userId"], ["begin"], F.col("id") % 5, "total")
    plain = Window.partitionBy("userId").orderBy(*order)
    upto = Window.partitionBy("userId").orderBy("begin").rangeBetween(Window.unboundedPreceding, 0)
    want = rows.select(
        "id",
        F.lag("id").over(plain).alias("before"),
        F.lead("id").over(plain).alias("after"),
        F.sum(F.col("id") % 5).over(upto).alias("total"),
    )
    seen = got.select("id", F.col("before.id").alias("before"), F.col("after.id").alias("after"), "total")
    assert sorted(seen.collect()) == sorted(want.collect())


def test_flags_and_clusters_are_worked_out_once(spark, capsys):
    data = [("aa01", "NY", 40.0, -75.0, dt.datetime(2024, 1, d, 12), dt.datetime(2024, 1, d, 13), 0.0, 0.0) for d in (1, 2, 3)]
    stops = spark.createDataFrame(data, STOPS)
    merging.merge_stops(stops).explain()
    plan = capsys.readouterr().out
    assert "lag(" not in plan and plan.count("sum(opens_group") >= 1
    zones = spark.createDataFrame([], "geohash5 string, tzid string")
    places.places(mobility.located_stops(stops, zones, how="left")).explain()
    assert "ArrowEvalPython" not in capsys.readouterr().out
