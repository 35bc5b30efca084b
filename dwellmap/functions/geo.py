"""Distances and geohashes as plain column expressions, so they stay in generated JVM code."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Sphere radius in metres and the geohash alphabet.
EARTH_RADIUS_M = 6372.795 * 1000
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres between two points given in radians."""
    lat1, lon1, lat2, lon2 = (_col(c) for c in (lat1, lon1, lat2, lon2))
    half_chord = F.pow(F.sin((lat2 - lat1) / 2), F.lit(2)) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / 2), F.lit(2)
    )
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(half_chord))


def haversine_np(lat1, lon1, lat2, lon2) -> np.ndarray:
    """The same distance for NumPy arrays inside an Arrow task; broadcasts like NumPy does."""
    half_chord = (
        np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    )
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(half_chord))


class Beyond:
    """Whether points of an array (radians) are more than ``limit`` metres apart, as ``haversine_np`` has it.

    On a plane that is nowhere narrower than the globe most pairs are surely near; only the others take sines.
    """

    def __init__(self, lat: np.ndarray, lon: np.ndarray, limit: float):
        self.lat, self.lon, self.limit = lat, lon, limit
        angle = limit / (2 * EARTH_RADIUS_M)
        # From half the globe's girth on, nothing is beyond.
        half_chord = np.sin(angle) ** 2 if 0 <= angle < np.pi / 2 else 0.0
        self.surely_near = 4 * half_chord * (1 - 1e-9)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        lat, lon = self.lat, self.lon
        north, east = lat[j] - lat[i], lon[j] - lon[i]
        far = ~(north * north + east * east <= self.surely_near)
        rest = np.flatnonzero(far)
        i, j = i[rest], j[rest]
        far[rest] = haversine_np(lat[i], lon[i], lat[j], lon[j]) > self.limit
        return far


def _interleaved_alphabet() -> str:
    """The alphabet reordered so that a character is found at ``4 * a + b``.

    ``a`` are the three bits of the axis the character starts with, ``b`` the two of the other.
    """
    def index(a: int, b: int) -> int:
        return sum(
            bit << place
            for place, bit in enumerate((a & 1, b & 1, a >> 1 & 1, b >> 1 & 1, a >> 2 & 1))
        )

    return "".join(GEOHASH_ALPHABET[index(a, b)] for a in range(8) for b in range(4))


_PAIRED_ALPHABET = _interleaved_alphabet()


def geohash(lat: str, lon: str, length: int) -> Column:
    """Geohash of a point in degrees, 1 to 12 characters; null when a coordinate is.

    ``lat`` and ``lon`` are column names or SQL expressions. Both axes are scaled to integers
    once; each character then takes three bits of one and two of the other, starting with
    longitude and taking turns.
    """
    if not 1 <= length <= 12:
        raise ValueError("geohash length must be between 1 and 12")
    lon_bits, lat_bits = (5 * length + 1) // 2, 5 * length // 2

    def scaled(axis: str, low: int, extent: int, bits: int) -> str:
        cell, top = f"floor((({axis}) - ({low}D)) / {extent}D * {1 << bits}D)", (1 << bits) - 1
        return f"CASE WHEN {cell} < 0 THEN 0L WHEN {cell} > {top} THEN {top}L ELSE {cell} END"

    first = [scaled(lon, -180, 360, lon_bits), lon_bits]
    second = [scaled(lat, -90, 180, lat_bits), lat_bits]
    chars = []
    for _ in range(length):
        first[1] -= 3
        second[1] -= 2
        a, b = (f"shiftright({cell}, {left})" for cell, left in (first, second))
        index = f"CAST(({a} & 7) * 4 + ({b} & 3) + 1 AS INT)"
        chars.append(f"substring('{_PAIRED_ALPHABET}', {index}, 1)")
        first, second = second, first
    return F.expr(f"concat({', '.join(chars)})")


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``geohash(lat, lon, n)`` and ``haversine_m(lat1, lon1, lat2, lon2)`` usable from SQL.

    Both are SQL functions, so a query that calls them is inlined and optimised as usual.
    """
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION geohash(lat DOUBLE, lon DOUBLE, n INT)
        RETURNS STRING
        RETURN array_join(transform(sequence(0, n - 1), ch -> substring('{GEOHASH_ALPHABET}',
          CAST(1 + aggregate(sequence(5 * ch, 5 * ch + 4), 0L, (acc, b) -> acc * 2 +
            CASE WHEN b % 2 = 0
              THEN least(greatest(CAST(floor((lon + 180) / 360 * pow(2, b div 2 + 1)) AS BIGINT), 0L),
                         CAST(pow(2, b div 2 + 1) AS BIGINT) - 1) % 2
              ELSE least(greatest(CAST(floor((lat + 90) / 180 * pow(2, b div 2 + 1)) AS BIGINT), 0L),
                         CAST(pow(2, b div 2 + 1) AS BIGINT) - 1) % 2 END) AS INT), 1)), '')
        """
    )
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION haversine_m(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
        RETURNS DOUBLE
        RETURN {2 * EARTH_RADIUS_M}D * asin(sqrt(pow(sin((lat2 - lat1) / 2), 2)
          + cos(lat1) * cos(lat2) * pow(sin((lon2 - lon1) / 2), 2)))
        """
    )
