"""Table functions for SQL: a table argument with its own partitioning and order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from dwellmap.operators.stops import _STOP_ARROW, _TRACK_FIELDS, MIN_STAY_MIN, _walk_all
from dwellmap.operators.trajectory import ROAM_DIST_M

_KEY = ("process_day", "userId", "chunk")
_RETURNS = (
    "process_day date, userId string, chunk int, serial int, latitude double, longitude double, begin_us bigint, "
    "end_us bigint, personal_area boolean, distance double, after_stop_distance double, dist_sum double"
)


def _joined(*parts: pa.RecordBatch) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def register_stop_function(
    spark: SparkSession,
    name: str = "detect_stops",
    roam_dist: float = ROAM_DIST_M,
    min_stay: float = MIN_STAY_MIN,
) -> None:
    """Make stop detection callable from SQL as a table function over pings::

        SELECT * FROM detect_stops(TABLE(
          SELECT * FROM pings DISTRIBUTE BY process_day, userId SORT BY process_day, userId, chunk, timestamp))

    The table holds, besides these columns, ``latitude`` and ``longitude`` in radians, ``distance_prev`` and
    ``personal_area``; others are not looked at. The pings of a trajectory must lie in one task, together and in
    order of time, as above or by ``TABLE(pings) PARTITION BY (process_day, userId, chunk) ORDER BY timestamp``. The
    latter starts the function anew for every trajectory, which takes several times as long. A task holds one
    batch of pings and one trajectory at a time. The rows are those of ``stops.detect_stops``, with times in
    microseconds: one per stop, and one with null stop columns for a trajectory without stops.
    """
    stay_us = int(min_stay * 60_000_000)

    def starts_within(batch: pa.RecordBatch) -> np.ndarray:
        """Rows, but for the first, at which another trajectory begins."""
        changed = np.zeros(max(batch.num_rows - 1, 0), bool)
        for key in _KEY:
            before, after = batch.column(key)[:-1], batch.column(key)[1:]
            changed |= pc.fill_null(pc.not_equal(before, after), False).to_numpy(zero_copy_only=False)
            changed |= pc.not_equal(before.is_null(), after.is_null()).to_numpy(zero_copy_only=False)
        return np.flatnonzero(changed) + 1

    @F.arrow_udtf(returnType=_RETURNS)
    class DetectStops:
        def __init__(self):
            # The trajectory that may go on in the next batch.
            self.parts: list[pa.RecordBatch] = []

        def eval(self, pings: pa.RecordBatch) -> Iterator[pa.Table]:
            batch = pings.select([*_KEY, *_TRACK_FIELDS])
            if not batch.num_rows:
                return
            starts = starts_within(batch)
            whole = list(self.parts)
            if len(starts):
                whole.append(batch.slice(0, starts[-1]))
                self.parts = [batch.slice(starts[-1])]
            elif whole and len(starts_within(_joined(whole[-1].slice(whole[-1].num_rows - 1), batch.slice(0, 1)))):
                self.parts = [batch]
            else:
                self.parts.append(batch)
                return
            if whole:
                yield self._stops(whole)

        def terminate(self) -> Iterator[pa.Table]:
            if self.parts:
                yield self._stops(self.parts)

        def _stops(self, parts: list[pa.RecordBatch]) -> pa.Table:
            whole = _joined(*parts)
            starts = np.concatenate([[0], starts_within(whole)])
            track = [
                (c.cast(pa.int64()) if pa.types.is_timestamp(c.type) else c).to_numpy(zero_copy_only=False)
                for c in (whole.column(field) for field in _TRACK_FIELDS)
            ]
            keys = [whole.column(key).take(pa.array(starts)) for key in _KEY]
            midnights = (keys[0].cast(pa.int32()).to_numpy(zero_copy_only=False) + 1) * np.int64(86_400_000_000)
            bounds = np.append(starts, whole.num_rows)
            counts, _, found = _walk_all(track, bounds, midnights, float(roam_dist), stay_us)
            # A trajectory without stops has a row as well, to which no stop belongs.
            shown = np.maximum(counts, 1)
            owner = pa.array(np.repeat(np.arange(len(starts)), shown))
            empty = np.repeat(counts == 0, shown)
            at = pa.array(np.cumsum(~empty) - 1, mask=empty)
            metres = np.array([track[3][start:end].sum() for start, end in zip(bounds[:-1], bounds[1:])])
            columns = {key: values.take(owner) for key, values in zip(_KEY, keys)}
            for field, values in zip(_STOP_ARROW, found, strict=True):
                columns[field.name] = pa.array(values, field.type).take(at)
            columns["dist_sum"] = pa.array(metres, pa.float64()).take(owner)
            return pa.table(columns)

    spark.udtf.register(name, DetectStops)
