import numpy as np
import pytest
from pyspark.sql import functions as F

from dwellmap.functions.geo import haversine_np
from dwellmap.operators.proximity import near_points

SCHEMA = "id long, latitude double, longitude double"


def brute(points, others, radius):
    out = {}
    for key, lat, lon in points:
        near = []
        for other, la, lo in others:
            if None in (lat, lon, la, lo):
                continue
            apart = haversine_np(*map(np.radians, (lat, lon, la, lo)))
            if apart <= radius:
                near.append((round(float(apart), 3), other))
        out[key] = (len(near), min(near)[1] if near else None, min(near)[0] if near else None)
    return out


def points(rng, n, first, lat, lon, spread):
    return [
        (first + i, float(np.clip(lat + rng.normal() * spread, -90, 90)), float(lon + rng.normal() * spread))
        for i in range(n)
    ]


@pytest.mark.parametrize("lat,lon", [(40.0, -75.0), (0.0, 180.0), (-89.999, 30.0), (89.9, -179.9), (60.0, 0.0)])
@pytest.mark.parametrize("limit", [3, 4096])
def test_equals_all_pairs(spark, lat, lon, limit):
    rng = np.random.default_rng(int(abs(lat)))
    here = points(rng, 150, 0, lat, lon, 0.01) + [(998, None, 1.0), (999, float("nan"), 1.0)]
    there = points(rng, 200, 0, lat, lon, 0.01) + [(500, lat, lon)] * 12 + [(501, lat, None)]
    got = near_points(
        spark.createDataFrame(here, SCHEMA),
        spark.createDataFrame(there, "other long, latitude double, longitude double"),
        400.0, "id", "other", cell_limit=limit,
    ).collect()
    want = brute(here, there, 400.0)
    assert len(got) == len(want)
    for row in got:
        n, nearest, metres = want[row.id]
        assert (row.n_near, row.nearest) == (n, nearest)
        assert metres is None or abs(row.nearest_m - metres) < 2e-3


def test_wide_radius_and_empty_sets(spark):
    rng = np.random.default_rng(1)
    here = [(i, float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(-90, 90, 80), rng.uniform(-180, 180, 80)))]
    frame = spark.createDataFrame(here, SCHEMA)
    others = frame.withColumnRenamed("id", "row")
    want = brute(here, here, 3_000_000.0)
    got = {r.id: r.n_near for r in near_points(frame, others, 3_000_000.0, "id", "row").collect()}
    assert got == {k: v[0] for k, v in want.items()}
    assert near_points(frame.limit(0), others, 50.0, "id", "row").collect() == []
    none = near_points(frame, others.limit(0), 50.0, "id", "row")
    assert none.agg(F.sum("n_near"), F.count("nearest"), F.count("*")).first() == (0, 0, 80)


def test_joins_by_equality_only(spark, capsys):
    frame = spark.createDataFrame([(1, 40.0, -75.0)], SCHEMA)
    near_points(frame, frame, 100.0, "id", "id").explain("formatted")
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_points_at_one_spot_are_compared_once(spark):
    """Pairs grow with the spots, not with the points that share them: 10^9 pairs of points here, 4 of spots."""
    spot = ("40 + id % 2 * 0.001 AS latitude", "-75D AS longitude")
    here = spark.range(100_000).selectExpr("id", *spot)
    there = spark.range(10_000).selectExpr("id + 7 AS other", *spot)
    counts = near_points(here, there, 50.0, "id", "other", cell_limit=2).groupBy("n_near", "nearest", "nearest_m").count()
    assert {tuple(r) for r in counts.collect()} == {(5000, 8, 0.0, 50_000), (5000, 7, 0.0, 50_000)}


def test_a_key_at_two_spots_is_one_row(spark):
    here = spark.createDataFrame([(1, 40.0, -75.0), (1, 41.0, -75.0), (2, 43.0, 0.0), (2, None, 0.0)], SCHEMA)
    there = spark.createDataFrame([(5, 40.0, -75.0), (4, 40.0, -75.0), (6, 41.0, -75.0)], "o long, latitude double, longitude double")
    got = near_points(here, there, 10.0, "id", "o").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 3, 4, 0.0), (2, 0, None, None)]
