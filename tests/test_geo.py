"""Geohash and distance expressions."""

import random

import pytest
from pyspark.sql import functions as F

from dwellmap.functions.geo import (
    GEOHASH_ALPHABET, geohash, haversine_m, haversine_np, register_sql_functions,
)


def bisect(lat, lon, length):
    """Geohash by halving the ranges bit by bit."""
    box = [[-180.0, 180.0], [-90.0, 90.0]]
    bits = []
    for i in range(5 * length):
        low, high = box[i % 2]
        mid, value = (low + high) / 2, (lon, lat)[i % 2]
        bits.append(int(value >= mid))
        box[i % 2] = [mid, high] if value >= mid else [low, mid]
    return "".join(
        GEOHASH_ALPHABET[int("".join(map(str, bits[k : k + 5])), 2)] for k in range(0, len(bits), 5)
    )


def points(spark, rows):
    return spark.createDataFrame(rows, "lat double, lon double")


def test_known_vector(spark):
    row = points(spark, [(57.64911, 10.40744)]).select(
        *[geohash("lat", "lon", n).alias(f"g{n}") for n in range(1, 13)]
    ).first()
    assert row.g11 == "u4pruydqqvj"
    assert all(row.g12.startswith(g) for g in row)


def test_edges_and_nulls(spark):
    rows = [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (None, 1.0), (1.0, None)]
    got = [r[0] for r in points(spark, rows).select(geohash("lat", "lon", 5)).collect()]
    assert got == ["zzzzz", "00000", "s0000", None, None]


def test_length_is_checked():
    with pytest.raises(ValueError):
        geohash("lat", "lon", 13)


def test_agrees_with_bisection(spark):
    rng = random.Random(1)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(2000)]
    got = points(spark, rows).select("lat", "lon", geohash("lat", "lon", 7).alias("g")).collect()
    assert [r.g for r in got] == [bisect(r.lat, r.lon, 7) for r in got]


def test_sql_functions(spark):
    register_sql_functions(spark)
    rows = [(57.64911, 10.40744), (-33.9, 151.2), (90.0, 180.0), (-90.0, -180.0)]
    frame = points(spark, rows)
    frame.createOrReplaceTempView("points")
    got = spark.sql("SELECT geohash(lat, lon, 7) AS g FROM points").collect()
    assert [r.g for r in got] == [r[0] for r in frame.select(geohash("lat", "lon", 7)).collect()]
    metres = spark.sql("SELECT haversine_m(0D, 0D, radians(1D), 0D) AS m").first().m
    assert metres == pytest.approx(111226.2, abs=0.1)


def test_distance_forms_agree(spark):
    pairs = spark.range(100).select(*[F.rand(i).alias(c) for i, c in enumerate("abcd")])
    for row in pairs.withColumn("m", haversine_m("a", "b", "c", "d")).collect():
        assert row.m == pytest.approx(haversine_np(row.a, row.b, row.c, row.d), rel=1e-12)
