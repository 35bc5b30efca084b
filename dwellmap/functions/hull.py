"""Diameter of a set of points on the globe by its convex hull."""

from __future__ import annotations

import numpy as np

from dwellmap.functions.geo import haversine_np

_FEW = 64


def _widest_of_all(lat: np.ndarray, lon: np.ndarray) -> float:
    """Largest distance over all pairs, compared in blocks."""
    widest = 0.0
    for start in range(0, len(lat), 256):
        some = slice(start, start + 256)
        widest = max(widest, float(haversine_np(lat[some, None], lon[some, None], lat, lon).max()))
    return widest


def _hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Indexes of the hull's corners in counter-clockwise order, for distinct points of a plane."""
    order = np.lexsort((y, x))
    px, py = x[order].tolist(), y[order].tolist()

    def chain(indexes) -> list[int]:
        corners: list[int] = []
        for i in indexes:
            while len(corners) > 1:
                a, b = corners[-2], corners[-1]
                if (px[b] - px[a]) * (py[i] - py[a]) > (py[b] - py[a]) * (px[i] - px[a]):
                    break
                corners.pop()
            corners.append(i)
        return corners[:-1]

    n = len(px)
    return order[chain(range(n)) + chain(range(n - 1, -1, -1))]


def _widest_of_corners(lat: np.ndarray, lon: np.ndarray) -> float:
    """Largest distance between corners of a convex polygon, given in their order.

    Of two corners, the one further round has its farthest corner further round as well, since the diagonals
    of a convex quadrilateral are together at least as long as two opposite sides, on a sphere too. So the
    farthest corner of the middle one halves the search for those before and after it, as the turning
    callipers do step by step. All ranges of a level are measured at once.
    """
    n = len(lat)
    widest = 0.0
    # Corners first..last still to be measured, against corners low..high, counted on round the polygon.
    first, last = np.array([0]), np.array([n - 1])
    low, high = np.array([1]), np.array([2 * n - 2])
    while len(first):
        middle = (first + last) // 2
        start, stop = np.maximum(low, middle + 1), np.minimum(high, middle + n - 1)
        sizes = stop - start + 1
        offsets = np.cumsum(sizes) - sizes
        one = np.repeat(middle, sizes)
        other = np.arange(sizes.sum()) - np.repeat(offsets - start, sizes)
        apart = haversine_np(lat[one], lon[one], lat[other % n], lon[other % n])
        most = np.maximum.reduceat(apart, offsets)
        widest = max(widest, float(most.max()))
        at = np.flatnonzero(apart == np.repeat(most, sizes))
        farthest = other[at[np.searchsorted(at, offsets)]]
        before, after = first < middle, middle < last
        first, last, low, high = (
            np.concatenate(parts)
            for parts in (
                (first[before], middle[after] + 1),
                (middle[before] - 1, last[after]),
                (low[before], farthest[after]),
                (farthest[before], high[after]),
            )
        )
    return widest


def diameter_m(lat: np.ndarray, lon: np.ndarray) -> float:
    """Largest distance in metres between any two of the points, given in radians; 0 for less than two.

    Takes n log n steps: the farthest two are corners of the convex hull, found in a projection from the
    centre of the globe, which keeps great circles straight. Points that reach further round the globe than
    such a projection can show are compared with each other.
    """
    # Most stops have few pings, whose pairs take less time than sorting them.
    if len(lat) > _FEW:
        spots = np.unique(np.column_stack((lat, lon)), axis=0)
        lat, lon = spots[:, 0], spots[:, 1]
    if len(lat) <= _FEW:
        return _widest_of_all(lat, lon) if len(lat) > 1 else 0.0
    away = np.column_stack((np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)))
    middle = away.mean(axis=0)
    length = np.linalg.norm(middle)
    if length < 0.5 or (away @ middle).min() < 0.5 * length:
        return _widest_of_all(lat, lon)
    middle /= length
    east = np.cross(middle, np.eye(3)[np.argmin(np.abs(middle))])
    east /= np.linalg.norm(east)
    north = np.cross(middle, east)
    # Differences to the middle keep their digits where all points are metres apart.
    apart, depth = away - middle, away @ middle
    corners = _hull(apart @ east / depth, apart @ north / depth)
    if len(corners) <= _FEW:
        return _widest_of_all(lat[corners], lon[corners])
    return _widest_of_corners(lat[corners], lon[corners])
