"""Place clustering: both ways against brute force, also around the poles and the date line."""

import datetime as dt
import math
import random

import numpy as np
import pytest

from dwellmap.functions.geo import EARTH_RADIUS_M, haversine_np
from dwellmap.functions import graph
from dwellmap.operators import clustering, places

DEGREE_M = EARTH_RADIUS_M * np.pi / 180
STOPS = "userId string, state string, latitude double, longitude double, begin timestamp, end timestamp"


def brute_force(lat, lon, eps):
    """Component of each point, numbered by first appearance."""
    lat, lon = np.radians(lat), np.radians(lon)
    near = haversine_np(lat[:, None], lon[:, None], lat[None, :], lon[None, :]) <= eps
    labels = np.full(len(lat), -1)
    for i in range(len(lat)):
        if labels[i] < 0:
            label, todo = labels.max() + 1, [i]
            labels[i] = label
            while todo:
                for k in np.flatnonzero(near[todo.pop()] & (labels < 0)):
                    labels[k] = label
                    todo.append(k)
    return labels.tolist()


def scene(seed):
    """Points scattered so that clusters are often joined by gaps close to eps."""
    rng = random.Random(seed)
    lat0, lon0 = rng.choice([(40.0, -75.0), (0.0, 0.0), (-33.0, 180.0), (89.9999, 10.0), (-89.9995, -170.0), (71.0, -180.0)])
    n, spread = rng.choice([(1, 10), (60, 300), (150, 800), (150, 60)])
    lat = np.clip([lat0 + rng.uniform(-spread, spread) / DEGREE_M for _ in range(n)], -90, 90)
    widen = np.maximum(np.cos(np.radians(lat)), 1e-3)
    lon = lon0 + np.array([rng.uniform(-spread, spread) for _ in range(n)]) / DEGREE_M / widen
    return lat, (lon + 180) % 360 - 180


def rows(lat, lon, user="aa01", state="NY"):
    start = dt.datetime(2024, 1, 1)
    return [
        (user, state, float(a), float(b), start + dt.timedelta(hours=i), start + dt.timedelta(hours=i, minutes=30))
        for i, (a, b) in enumerate(zip(lat, lon))
    ]


def labels(spark, data, **options):
    found = clustering.cluster_places(spark.createDataFrame(data, STOPS), **options)
    return [r.clusterId for r in found.orderBy("userId", "state", "begin").collect()]


@pytest.mark.parametrize("seed", range(40))
def test_list_kernel(seed):
    lat, lon = scene(seed)
    assert clustering._label(np.radians(lat), np.radians(lon), 65.0).tolist() == brute_force(lat, lon, 65.0)


def test_both_ways_agree_with_brute_force(spark):
    data, want = [], []
    for seed in range(24):
        lat, lon = scene(seed)
        data += rows(lat, lon, user=f"user{seed:02d}")
        want += brute_force(lat, lon, 65.0)
    assert labels(spark, data) == want
    assert labels(spark, data, group_limit=0) == want
    # Some users above the limit, some below.
    assert labels(spark, data, group_limit=100) == want


def test_dense_cells_with_a_gap_near_eps_are_decided_exactly(spark):
    """Two crowds whose closest stops are just under, or just over, eps apart."""
    rng = random.Random(7)
    for gap, places_wanted in ((64.999, 1), (65.001, 2)):
        west = [-rng.random() * 20 for _ in range(400)] + [0.0]
        east = [gap + rng.random() * 20 for _ in range(400)] + [gap]
        lon = np.array(west + east) / DEGREE_M
        data = rows(np.zeros(len(lon)), lon)
        assert len(set(labels(spark, data, group_limit=0))) == places_wanted
        assert len(set(labels(spark, data))) == places_wanted


def test_chain_is_one_place(spark):
    lat = 40 + np.arange(3) * 60 / DEGREE_M
    assert labels(spark, rows(lat, np.full(3, -75.0))) == [0, 0, 0]


def test_long_chain_through_the_graph_loop(spark):
    lat = 40 + np.arange(300) * 60 / DEGREE_M
    assert set(labels(spark, rows(lat, np.full(300, -75.0)), group_limit=0)) == {0}


def test_components(spark):
    rng = random.Random(3)
    pairs = {(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(150)} | {(500, v) for v in range(300, 400)}
    edges = spark.createDataFrame([("k", u, v) for u, v in pairs if u != v], "key string, u int, v int")
    found = {r.u: r.component for r in graph.connected_components(edges, ["key"]).collect()}
    least = {x: x for p in pairs for x in p}
    for _ in least:
        for u, v in pairs:
            least[u] = least[v] = min(least[u], least[v])
    assert all(found.get(x, x) == m for x, m in least.items())


def test_places_in_two_states_share_number_and_centre_unless_told_otherwise(spark):
    data = rows([40.0], [-75.0]) + rows([41.0], [-75.0], state="NJ")
    clustered = clustering.cluster_places(spark.createDataFrame(data, STOPS))
    (centre,) = places.cluster_centroids(clustered).collect()
    assert (centre.clusterId, centre.clusterLatitude) == (0, 40.5)
    apart = places.cluster_centroids(clustered, ("userId", "state", "clusterId")).collect()
    assert {(r.state, r.clusterLatitude) for r in apart} == {("NY", 40.0), ("NJ", 41.0)}


def test_offset_is_cut_towards_zero(spark):
    zones = spark.sql("SELECT * FROM VALUES ('dr4e3', 'America/St_Johns') AS t(geohash5, tzid)")
    cell = spark.range(1).select(places.geohash("40.0D", "-75.0D", 5).alias("g")).first().g
    zones = zones.selectExpr(f"'{cell}' AS geohash5", "tzid")
    clustered = clustering.cluster_places(spark.createDataFrame(rows([40.0], [-75.0]), STOPS))
    (row,) = places.local_offset(clustered, zones).collect()
    assert row.offset == -3 and row.prefix == "aa" and row.dayofyear == 1
    assert places.local_offset(clustered, zones.where("false")).count() == 0


def test_stops_without_user_state_or_time_are_kept(spark):
    data = rows([40.0, 40.0001, 41.0], [-75.0] * 3)
    data = [(*r[:4], None if i == 1 else r[4], r[5]) for i, r in enumerate(data)]
    data += [(None, None, *r[2:]) for r in data] + [("aa01", None, *r[2:]) for r in data]
    found = []
    for limit in (0, 10_000):
        clustered = clustering.cluster_places(spark.createDataFrame(data, STOPS), group_limit=limit)
        found.append(sorted((tuple(r) for r in clustered.collect()), key=str))
    assert found[0] == found[1] and len(found[0]) == 9
    assert {r[:2] for r in found[0]} == {("aa01", "NY"), (None, None), ("aa01", None)}


def test_a_hot_star_is_split(spark):
    """The edges of one vertex are dealt to several tasks once its minimum is written."""
    edges = spark.range(1, 60_001).selectExpr("'k' AS key", "id AS u", "0L AS v")
    found = graph.connected_components(edges, ["key"])
    assert found.where("component <> 0").count() == 0 and found.count() == 60_000


@pytest.mark.parametrize("seed", range(10))
def test_many_groups_at_once_agree_with_each_by_cells(seed):
    rng = np.random.default_rng(seed)
    groups = []
    for size in rng.choice([0, 1, 2, 9, 64, 65, 100], 20):
        lat = 0.7 + rng.choice([rng.normal(0, 2e-5, size), rng.permutation(size) * 1e-5], axis=0)
        lon = np.pi * rng.choice([-1, 1], size) - rng.normal(0, 1e-6, size)
        groups.append((lat, lon))
    bounds = np.cumsum([0, *(len(lat) for lat, _ in groups)])
    got = clustering._label_all(*(np.concatenate(axis) for axis in zip(*groups)), bounds, 65)
    assert got.tolist() == np.concatenate([clustering._label(*group, 65) for group in groups]).tolist()


def test_small_groups_of_cells_need_no_graph_loop(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(f"u{g}", "PA", *map(int, rng.integers(0, 12, 4))) for g in range(20) for _ in range(3 + 9 * (g % 3))]
    rows = [r for r in rows if r[2:4] != r[4:]] + [("u99", None, 1, 1, 1, 2)]
    pairs = spark.createDataFrame(rows, "userId string, state string, row long, col long, near_row long, near_col long")
    pairs = pairs.fillna("\0", ["state"])

    def found(**options):
        # The loop leaves out the smallest cells themselves.
        return {tuple(r) for r in clustering._components(pairs, **options).collect() if r.u != r.component}

    wanted = found(edge_limit=0)
    monkeypatch.setattr(clustering, "EDGE_LIMIT", 15)
    assert found() == wanted
    monkeypatch.setattr(clustering, "EDGE_LIMIT", 1000)
    monkeypatch.setattr(clustering, "connected_components", None)
    assert found() == wanted


def test_cells_meet_their_neighbours_by_blocks(spark):
    rng = np.random.default_rng(6)
    side = clustering._CELL_SHRINK * 65 / math.sqrt(2) / EARTH_RADIUS_M
    # Around the date line, close to a pole, and at the equator.
    spots = [(0.0, math.pi), (math.pi / 2 - 3 * side, 1.0), (0.7, -1.0)]
    rows = [
        (lat + float(a) * side, (lon + float(b) * side / max(math.cos(lat), 0.01) + math.pi) % (2 * math.pi) - math.pi)
        for lat, lon in spots for a, b in rng.uniform(-6, 6, (60, 2))
    ]
    rows = [(min(lat, math.pi / 2), lon) for lat, lon in rows]
    points = spark.createDataFrame([("u", "s", "", *r) for r in rows], "userId string, state string, path string, lat double, lon double")
    nodes = clustering._nodes(clustering._with_cell(points, side)).localCheckpoint()
    key = ["row", "col", "near_row", "near_col"]
    found = [tuple(r) for r in clustering._cell_pairs(nodes, side, 65).select(*key).collect()]
    assert len(found) == len(set(found))
    placed = clustering._with_cell(points, side).select("lat", "lon", "row", "col").collect()
    for i, a in enumerate(placed):
        for b in placed[:i]:
            (r, c), (s, d) = sorted(((a.row, a.col), (b.row, b.col)))
            if (r, c) != (s, d) and haversine_np(a.lat, a.lon, b.lat, b.lon) <= 65:
                assert (r, c, s, d) in found
