"""Clustering a user's stops into places: stops within ``eps`` metres share a place, transitively.

With a minimum cluster size of one, density clustering equals the connected components of the
"within eps" graph. Stops are binned into cells whose diagonal is below ``eps``: stops of one cell
always belong together, so only neighbouring cells need comparing and no pairs are listed inside a
cell.

Users of ordinary size are clustered as one Arrow list each. A user-state with more stops than
``group_limit`` is spread over the cluster instead: cells are compared by a member and a bounding
box, undecided pairs of cells are split into quarters until decided, and cells are joined into
components, for groups with more than ``EDGE_LIMIT`` pairs of touching cells by a distributed graph loop. Both ways are exact and give the same numbering.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmap.functions.geo import EARTH_RADIUS_M, Beyond, haversine_m, haversine_np
from dwellmap.functions.graph import connected_components
from dwellmap.functions.timeline import by_span, with_running_total
from dwellmap.session import discard, materialise

ROAM_DIST_STOPS_M = 65
GROUP_LIMIT = 10_000
GROUP = ["userId", "state"]
STOP_ORDER = ["begin", "end", "latitude", "longitude"]
# Stands for a missing user or state while stops are joined by them.
_UNKNOWN = "\0"

# Cells are a little smaller than eps / sqrt(2), so that rounding cannot stretch the diagonal.
_CELL_SHRINK = 0.999
_SPLIT = 4
# Groups of so many stops are compared stop by stop.
_FEW = 64
# Cells of a row are looked up by blocks of so many.
_BLOCK = 8
# Groups with more pairs of touching cells are joined by the graph loop, others in one list.
EDGE_LIMIT = 50_000


# --- ordinary users: one Arrow list per user and state ------------------------------------------


class _Forest:
    """Disjoint sets over 0..n-1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)


def _any_within(lat, lon, left: np.ndarray, right: np.ndarray, eps: float) -> bool:
    """Whether some stop of ``left`` is within ``eps`` of one of ``right``, in blocks."""
    for start in range(0, len(left), 512):
        block = left[start : start + 512, None]
        if (haversine_np(lat[block], lon[block], lat[right], lon[right]) <= eps).any():
            return True
    return False


def _label(lat: np.ndarray, lon: np.ndarray, eps: float) -> np.ndarray:
    """Place number of each stop (radians), numbered by first appearance."""
    n = len(lat)
    if n < 2:
        return np.zeros(n, dtype=np.int32)
    side = _CELL_SHRINK * eps / math.sqrt(2) / EARTH_RADIUS_M
    row = np.floor(lat / side).astype(np.int64)
    # Columns are as wide as one side at the row's edge nearest the equator, whole around the globe.
    edge = np.where(row >= 0, row, -row - 1) * side
    around = np.maximum(1, np.ceil(2 * math.pi * np.cos(np.minimum(edge, math.pi / 2)) / side))
    col = np.minimum(np.floor((lon + math.pi) / (2 * math.pi) * around), around - 1).astype(np.int64)
    cells: dict[tuple[int, int], list[int]] = {}
    for i, key in enumerate(zip(row.tolist(), col.tolist())):
        cells.setdefault(key, []).append(i)
    forest = _Forest(n)
    members = {}
    for key, inside in cells.items():
        members[key] = np.asarray(inside)
        for i in inside[1:]:
            forest.join(inside[0], i)
    # Cells far apart in rows cannot touch; within the reachable rows every nearby cell is checked.
    by_row: dict[int, list[tuple[int, int]]] = {}
    for key in members:
        by_row.setdefault(key[0], []).append(key)
    mid_lon = {key: lon[inside[0]] for key, inside in cells.items()}
    order = {r: sorted(keys, key=lambda k: mid_lon[k]) for r, keys in by_row.items()}
    lons = {r: np.array([mid_lon[k] for k in keys]) for r, keys in order.items()}
    for key, inside in members.items():
        for r in range(key[0], key[0] + 3):
            if r not in order:
                continue
            for other in _near_in_row(key, mid_lon[key], r, order[r], lons[r], side, eps):
                if r == key[0] and other <= key:
                    continue
                if forest.root(inside[0]) != forest.root(members[other][0]) and _any_within(
                    lat, lon, inside, members[other], eps
                ):
                    forest.join(inside[0], members[other][0])
    roots = np.array([forest.root(i) for i in range(n)])
    # A root is the smallest index of its set, so sorting roots numbers by first appearance.
    return np.unique(roots, return_inverse=True)[1].astype(np.int32)


def _near_in_row(key, at, r, keys, lons, side, eps):
    """Cells of row ``r`` whose stops may lie within ``eps`` of stops in cell ``key``."""
    polar = max(abs(key[0]), abs(key[0] + 1), abs(r), abs(r + 1)) * side
    reach = _lon_reach(polar, eps + 2 * side * EARTH_RADIUS_M * 1.5)
    if reach >= math.pi:
        return keys
    picked: list = []
    for turn in (-2 * math.pi, 0.0, 2 * math.pi):
        lo, hi = np.searchsorted(lons, [at - reach + turn, at + reach + turn])
        picked.extend(keys[lo:hi])
    return picked


def _lon_reach(lat: float, metres: float) -> float:
    """Largest longitude difference of two points within ``metres`` up to latitude ``lat``."""
    ratio = math.sin(metres / (2 * EARTH_RADIUS_M)) / max(math.cos(min(lat, math.pi / 2)), 1e-12)
    return math.pi if ratio >= 1 else 2 * math.asin(ratio)


def _label_all(lat: np.ndarray, lon: np.ndarray, bounds: np.ndarray, eps: float) -> np.ndarray:
    """Place numbers of the stops of many groups, one after another.

    In groups of up to ``_FEW`` stops all pairs are compared, of all such groups at once; cells are for larger ones.
    """
    starts, sizes = bounds[:-1], np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    few = sizes <= _FEW
    few[owner[np.isnan(lat) | np.isnan(lon)]] = False
    root, beyond = np.arange(len(lat)), Beyond(lat, lon, eps)
    room = np.where(few, starts, bounds[1:])[owner]
    at, back, pairs = np.flatnonzero(root > room), 1, []
    while len(at):
        near = at[~beyond(at - back, at)]
        pairs.append((near - back, near))
        back += 1
        at = at[at - back >= room[at]]
    left, right = (np.concatenate([p[k] for p in pairs] or [root[:0]]) for k in (0, 1))
    while (root[left] != root[right]).any():
        # The smaller root goes to both stops and to the larger root, then every stop takes its root's root.
        least, most = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
        np.minimum.at(root, most, least)
        for _ in range(_FEW.bit_length()):
            root = root[root]
    # A root is the smallest index of its set, so counting roots numbers by first appearance.
    number = np.cumsum(root == np.arange(len(root)))
    labels = (number[root] - number[starts[owner]]).astype(np.int32)
    for group in np.flatnonzero(~few):
        span = slice(bounds[group], bounds[group + 1])
        labels[span] = _label(lat[span], lon[span], eps)
    return labels


def _small_groups(stops: DataFrame, eps_m: float) -> DataFrame:
    @F.arrow_udf("array<int>")
    def label(lats: pa.Array, lons: pa.Array) -> pa.Array:
        sizes = lats.value_lengths().to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        lat, lon = (values.flatten().to_numpy(zero_copy_only=False) for values in (lats, lons))
        labels = _label_all(lat, lon, bounds, eps_m)
        return pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), pa.array(labels, type=pa.int32()))

    listed = stops.groupBy(*GROUP).agg(
        F.sort_array(F.collect_list(F.struct(*STOP_ORDER))).alias("stops")
    )
    radians = [F.transform(F.col(f"stops.{c}"), F.radians) for c in ("latitude", "longitude")]
    return (
        listed.withColumn("labels", label(*radians))
        .select(*GROUP, F.explode(F.arrays_zip("stops", "labels")).alias("at"))
        .select(*GROUP, "at.stops.*", F.col("at.labels").alias("clusterId"))
    )


# --- users too large for one task ----------------------------------------------------------------


def _edge_lat(row: Column, side: float) -> Column:
    """Latitude of a row's edge nearest the equator."""
    return F.when(row >= 0, row).otherwise(-row - 1) * F.lit(side)


def _around(row: Column, side: float) -> Column:
    """Number of columns in a row of cells."""
    edge = F.least(_edge_lat(row, side), F.lit(math.pi / 2))
    return F.greatest(F.lit(1), F.ceil(F.lit(2 * math.pi / side) * F.cos(edge)))


def _with_cell(points: DataFrame, side: float) -> DataFrame:
    """Add grid ``row`` and ``col`` to points given by ``lat`` and ``lon`` in radians."""
    placed = points.withColumn("row", F.floor(F.col("lat") / side))
    around = _around(F.col("row"), side)
    turn = (F.col("lon") + math.pi) / (2 * math.pi)
    return placed.withColumn("col", F.least(F.floor(turn * around), around - 1))


_CELL = [*GROUP, "row", "col"]
_NODE = [*_CELL, "path"]


def _nodes(points: DataFrame) -> DataFrame:
    """One row per (part of a) cell: a member, the bounding box, and how far members can be from it."""
    return (
        points.groupBy(*_NODE)
        .agg(
            # The first of both columns stand in one row; only fixed-width values, so this is a hash aggregate.
            F.first("lat").alias("rep_lat"),
            F.first("lon").alias("rep_lon"),
            *[f(c).alias(f"{p}_{c}") for c in ("lat", "lon") for p, f in (("lo", F.min), ("hi", F.max))],
        )
        .withColumn("rep", F.struct(F.col("rep_lat").alias("lat"), F.col("rep_lon").alias("lon")))
        .drop("rep_lat", "rep_lon")
        .withColumn(
            "spread",
            F.lit(EARTH_RADIUS_M)
            * (
                (F.col("hi_lat") - F.col("lo_lat"))
                + (F.col("hi_lon") - F.col("lo_lon"))
                * F.when((F.col("lo_lat") <= 0) & (F.col("hi_lat") >= 0), F.lit(1.0)).otherwise(
                    F.cos(F.least(F.abs("lo_lat"), F.abs("hi_lat")))
                )
            ),
        )
    )


def _judge(pairs: DataFrame, eps_m: float) -> DataFrame:
    """Decide pairs of nodes: 1 within eps, 0 surely not, null when they must be split."""
    apart = haversine_m("a.rep.lat", "a.rep.lon", "b.rep.lat", "b.rep.lon")
    slack = F.col("a.spread") + F.col("b.spread")
    surely_not = (F.col("slack") == 0) | (F.col("apart") - F.col("slack") * (1 + 1e-9) > eps_m)
    return (
        pairs.withColumns({"apart": apart, "slack": slack})
        .withColumn("verdict", F.when(F.col("apart") <= eps_m, 1).when(surely_not, 0))
        .drop("apart", "slack")
    )


def _cell_pairs(cells: DataFrame, side: float, eps_m: float) -> DataFrame:
    """Existing cells that may hold stops within eps of each other, each pair once.

    A cell looks up the at most about 15 cells around and above it, by row and block of columns: it meets
    those of at most two blocks in each of three rows, and nothing is compared all against all.
    """
    row = F.col("row")
    width = F.lit(2 * math.pi) / _around(row, side)
    near_row = F.col("near_row")
    polar = F.greatest(*[F.abs(x) for x in (row, row + 1, near_row, near_row + 1)]) * F.lit(side)
    ratio = F.lit(math.sin(eps_m / (2 * EARTH_RADIUS_M))) / F.greatest(
        F.cos(F.least(polar, F.lit(math.pi / 2))), F.lit(1e-12)
    )
    reach = F.when(ratio < 1, 2 * F.asin(F.least(ratio, F.lit(1.0))) * 1.001).otherwise(math.pi)
    near_around = _around(near_row, side)
    near_width = F.lit(2 * math.pi) / near_around
    first = F.floor((F.col("col") * width - reach) / near_width)
    last = F.floor(((F.col("col") + 1) * width + reach) / near_width)
    whole_row = last - first + 1 >= near_around
    block = lambda col: F.floor(col / F.lit(_BLOCK))
    around_globe = F.array_distinct(
        F.transform(F.sequence(first, last), lambda c: block(F.pmod(c, near_around)))
    )
    blocks = (
        F.when(whole_row, F.sequence(F.lit(0).cast("long"), block(near_around - 1)))
        .when((first >= 0) & (last < near_around), F.sequence(block(first), block(last)))
        .otherwise(around_globe)
    )
    looked_up = (
        cells.select(*_CELL, F.struct("rep", "spread").alias("a"))
        .withColumn("near_row", F.explode(F.sequence(row, row + 2)))
        .select("*", first.alias("first"), (last - first).alias("more"), F.explode(blocks).alias("near_block"))
    )
    there = cells.select(
        *GROUP,
        F.col("row").alias("near_row"),
        block(F.col("col")).alias("near_block"),
        F.col("col").alias("near_col"),
        F.struct("rep", "spread").alias("b"),
    )
    return (
        looked_up.join(there, [*GROUP, "near_row", "near_block"])
        .where(F.pmod(F.col("near_col") - F.col("first"), near_around) <= F.col("more"))
        .where((near_row > row) | (F.col("near_col") > F.col("col")))
        .drop("first", "more", "near_block")
    )


def _touching_cells(points: DataFrame, side: float, eps_m: float) -> DataFrame:
    """Pairs of cells with at least one pair of stops within eps."""
    pair = [*_CELL, "near_row", "near_col"]
    # Written, as both sides of the pairs are read from them.
    nodes = materialise(_nodes(points))
    judged = materialise(_judge(_cell_pairs(nodes, side, eps_m), eps_m).where("verdict IS NULL OR verdict = 1"))
    discard(nodes)
    touching = judged.where("verdict = 1").select(*pair)
    undecided = judged.where("verdict IS NULL").select(
        *pair, F.lit("").alias("a_path"), F.lit("").alias("b_path")
    )
    if undecided.take(1):
        undecided = materialise(_still_apart(undecided, touching))
    while undecided.take(1):
        # Keep only points in undecided nodes and move each to its quarter of the node's box.
        sides = undecided.select(*GROUP, "row", "col", F.col("a_path").alias("path")).union(
            undecided.select(*GROUP, "near_row", "near_col", "b_path")
        )
        boxes = _nodes(points.join(sides.distinct(), _NODE, "left_semi"))
        path = F.concat("path", _part("lat"), _part("lon")).alias("path")
        points = materialise(points.join(boxes, _NODE).select(*_CELL, path, "lat", "lon").distinct())
        parts = _nodes(points)
        parent = F.expr("substring(path, 1, length(path) - 2)")
        node = F.struct("rep", "spread")
        a = parts.select(
            *_CELL, parent.alias("a_path"), F.col("path").alias("a_part"), node.alias("a")
        )
        b = parts.select(
            *GROUP,
            F.col("row").alias("near_row"),
            F.col("col").alias("near_col"),
            parent.alias("b_path"),
            F.col("path").alias("b_part"),
            node.alias("b"),
        )
        split = undecided.join(a, [*_CELL, "a_path"]).join(
            b, [*GROUP, "near_row", "near_col", "b_path"]
        )
        judged = materialise(_judge(split, eps_m))
        found = judged.where("verdict = 1").select(*pair).distinct()
        touching = touching.union(found)
        undecided = (
            judged.where("verdict IS NULL")
            .select(*pair, F.col("a_part").alias("a_path"), F.col("b_part").alias("b_path"))
            .join(found, pair, "left_anti")
        )
    return touching


def _edges(pairs: DataFrame) -> DataFrame:
    """Pairs of cells as graph edges (u, v)."""
    near = F.struct(F.col("near_row").alias("row"), F.col("near_col").alias("col"))
    return pairs.select(*GROUP, F.struct("row", "col").alias("u"), near.alias("v"))


def _smallest_joined(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest number reachable from each of 0..n-1 by pairs of numbers."""
    root = np.arange(n)
    while (root[left] != root[right]).any():
        least, most = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
        np.minimum.at(root, most, least)
        while ((up := root[root]) != root).any():
            root = up
    return root


_JOINED = "array<struct<u:struct<row:bigint,col:bigint>,component:struct<row:bigint,col:bigint>>>"


def _joined_cells(row: pa.Array, col: pa.Array, near_row: pa.Array, near_col: pa.Array) -> pa.Array:
    """Each group's cells that have an edge, with the smallest cell reachable; lists of edges come in."""
    sizes = row.value_lengths().to_numpy(zero_copy_only=False)
    ends = [v.flatten().to_numpy(zero_copy_only=False) for v in (row, col, near_row, near_col)]
    group = np.tile(np.repeat(np.arange(len(sizes)), sizes), 2)
    keys = np.concatenate(ends[::2]), np.concatenate(ends[1::2])
    order = np.lexsort((keys[1], keys[0], group))
    new = np.ones(len(order), bool)
    new[1:] = np.any([np.diff(k[order]) != 0 for k in (group, *keys)], axis=0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    cells = [k[order[new]] for k in keys]
    # Cells are numbered in order within their group, so the smallest number is the smallest cell.
    least = _smallest_joined(int(new.sum()), *np.split(number, 2))
    bounds = np.searchsorted(group[order[new]], np.arange(len(sizes) + 1)).astype(np.int32)
    both = [
        pa.StructArray.from_arrays([pa.array(k[i]) for k in cells], ["row", "col"])
        for i in (np.arange(len(least)), least)
    ]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(both, ["u", "component"]))


def _components(touching: DataFrame, edge_limit: int | None = None) -> DataFrame:
    """Smallest cell reachable from each cell ``u`` that touches another; the loop leaves out the smallest cells.

    A group's edges are one list each; groups with more edges than that, by default ``EDGE_LIMIT``, go through
    the graph loop.
    """
    limit = EDGE_LIMIT if edge_limit is None else edge_limit
    edges = materialise(_edges(touching))
    large = edges.groupBy(*GROUP).count().where(F.col("count") > limit).drop("count")
    few, many = edges, None
    if large.take(1):
        large = materialise(large)
        few, many = edges.join(large, GROUP, "left_anti"), edges.join(large, GROUP, "left_semi")
    listed = few.groupBy(*GROUP).agg(F.collect_list(F.struct("u", "v")).alias("e"))
    found = F.arrow_udf(_joined_cells, _JOINED)("e.u.row", "e.u.col", "e.v.row", "e.v.col")
    joined = listed.select(*GROUP, F.explode(found).alias("at")).select(*GROUP, "at.u", "at.component")
    return joined.unionByName(connected_components(many, GROUP)) if many is not None else joined


def _still_apart(pairs: DataFrame, touching: DataFrame) -> DataFrame:
    """Pairs of cells that are not already connected through other cells.

    In dense areas nearly all are, and their stops need no closer look.
    """
    known = _components(touching)
    known = known.select(*GROUP, "u.row", "u.col", "component")
    near_known = known.select(
        *GROUP,
        F.col("row").alias("near_row"),
        F.col("col").alias("near_col"),
        F.col("component").alias("near_component"),
    )
    return (
        pairs.join(known, _CELL, "left")
        .join(near_known, [*GROUP, "near_row", "near_col"], "left")
        .where("component IS NULL OR near_component IS NULL OR component <> near_component")
        .select(*pairs.columns)
    )


def _part(axis: str) -> Column:
    """Which of the equal parts of its node's box a point lies in, along one axis.

    The lowest and the highest point of a box always differ, so splitting comes to an end.
    """
    low, extent = F.col(f"lo_{axis}"), F.col(f"hi_{axis}") - F.col(f"lo_{axis}")
    part = F.floor((F.col(axis) - low) / extent * _SPLIT)
    return F.when(extent > 0, F.least(part, F.lit(_SPLIT - 1)).cast("string")).otherwise("0")


def _large_groups(stops: DataFrame, eps_m: float) -> DataFrame:
    side = _CELL_SHRINK * eps_m / math.sqrt(2) / EARTH_RADIUS_M
    placed = _with_cell(
        stops.withColumns({"lat": F.radians("latitude"), "lon": F.radians("longitude")}), side
    )
    points = placed.select(*_CELL, F.lit("").alias("path"), "lat", "lon")
    touching = _touching_cells(points, side, eps_m)
    components = _components(touching).withColumnRenamed("u", "cell")
    labelled = (
        placed.withColumn("cell", F.struct("row", "col"))
        .join(components, [*GROUP, "cell"], "left")
        .withColumn("component", F.coalesce("component", "cell"))
    )
    firsts = labelled.groupBy(*GROUP, "component").agg(F.min(F.struct(*STOP_ORDER)).alias("first"))
    numbered = with_running_total(
        by_span(firsts.select("*", "first.begin"), GROUP, "begin"),
        GROUP,
        ["first"],
        F.lit(1),
        "number",
    )
    ids = numbered.select(*GROUP, "component", (F.col("number") - 1).cast("int").alias("clusterId"))
    return labelled.join(ids, [*GROUP, "component"]).select(*GROUP, *STOP_ORDER, "clusterId")


def cluster_places(
    stops: DataFrame, eps_m: float = ROAM_DIST_STOPS_M, group_limit: int = GROUP_LIMIT
) -> DataFrame:
    """Give each stop (degrees) the number of its place within its user and state.

    Places are numbered from 0 by their first stop; a stop without a time comes first. Stops without
    a user or state form groups like any others. The stops are written to the shared folder first, as
    group sizes must be known before choosing how to cluster; both ways give the same places.
    """
    named = {c: F.coalesce(F.col(c), F.lit(_UNKNOWN)) for c in GROUP}
    known = materialise(stops.select(*GROUP, *STOP_ORDER).withColumns(named))
    return _cluster_known(known, eps_m, group_limit).withColumns(
        {c: F.nullif(F.col(c), F.lit(_UNKNOWN)) for c in GROUP}
    )


def _cluster_known(known: DataFrame, eps_m: float, group_limit: int) -> DataFrame:
    large = known.groupBy(*GROUP).count().where(F.col("count") > group_limit).drop("count")
    if not large.take(1):
        return _small_groups(known, eps_m)
    large = materialise(large)
    return _small_groups(known.join(large, GROUP, "left_anti"), eps_m).unionByName(
        _large_groups(known.join(large, GROUP, "left_semi"), eps_m)
    )
