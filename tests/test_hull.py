import time

import numpy as np
import pytest

from dwellmap.functions import hull


def cloud(rng, kind, n, lat, lon, metres):
    turn, far = rng.uniform(0, 2 * np.pi, n), np.sqrt(rng.uniform(0, 1, n))
    if kind == "circle":
        far[:] = 1
    if kind == "corners":
        turn, far = np.round(turn * 3 / np.pi) * np.pi / 3, np.ones(n)
    if kind == "line":
        turn[:] = 0.7
    if kind == "grid":
        dy, dx = np.round(far * np.sin(turn), 1), np.round(far * np.cos(turn), 1)
    else:
        dy, dx = far * np.sin(turn), far * np.cos(turn)
    reach = metres / 6_372_795
    return np.radians(lat) + dy * reach, np.radians(lon) + dx * reach / np.cos(np.radians(lat))


@pytest.mark.parametrize("kind", ["disc", "circle", "corners", "line", "grid"])
@pytest.mark.parametrize("lat,lon,metres", [(40, -75, 70), (0, 180, 5000), (-70, 10, 300_000), (45, 45, 9_000_000)])
def test_equals_all_pairs(kind, lat, lon, metres):
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 3, 70, 400):
        la, lo = cloud(rng, kind, n, lat, lon, metres)
        want = hull._widest_of_all(la, lo) if n else 0.0
        assert hull.diameter_m(la, lo) == pytest.approx(want, abs=1e-6 * max(1, metres / 70))


def test_hulls_of_many_corners_are_measured_without_all_pairs(monkeypatch):
    rng = np.random.default_rng(8)
    la, lo = cloud(rng, "circle", 3000, 40, -75, 5000)
    want = hull._widest_of_all(la, lo)
    monkeypatch.setattr(hull, "_widest_of_all", None)
    assert hull.diameter_m(la, lo) == pytest.approx(want, abs=1e-4)


@pytest.mark.parametrize("kind", ["disc", "circle"])
def test_hundred_thousand_points(kind):
    la, lo = cloud(np.random.default_rng(9), kind, 100_000, 40, -75, 70)
    started = time.process_time()
    assert 139.9 < hull.diameter_m(la, lo) < 140.01
    assert time.process_time() - started < 10


def test_repeated_points():
    assert hull.diameter_m(np.full(900, 0.7), np.full(900, -1.3)) == 0.0


def test_few_points_are_not_sorted(monkeypatch):
    """Sorting them took most of a stop's time."""
    def refuse(*args, **kwargs):
        raise AssertionError("sorted")

    monkeypatch.setattr("dwellmap.functions.hull.np.unique", refuse)
    lat, lon = np.radians([40.0, 40.001, 40.0]), np.radians([-75.0, -75.0, -75.0])
    assert hull.diameter_m(lat, lon) == pytest.approx(111.2, abs=0.1)
    assert hull.diameter_m(lat[:1], lon[:1]) == 0.0 and hull.diameter_m(lat[[0, 2]], lon[[0, 2]]) == 0.0
