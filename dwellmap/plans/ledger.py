"""Backfills over all stages that go on where they stopped.

A ledger table keeps a row whenever a unit of work, a stage of one country and day, is finished or struck out.
It is only ever appended to; the latest row of a unit counts. A run joins the days it is asked for against the
finished ones and works on the rest, so a run that failed half way, or in which a few days were struck out
because their input changed, does only what is left.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmap.operators import activity
from dwellmap.plans import mobility
from dwellmap.sources import sinks
from dwellmap.sources.tables import scan_date_range, scan_table

UNIT = ("stage", "country", "day")
_SCHEMA = "stage string, country string, day date, done boolean, at long"
STAGES = ("stops", "hours", "places")


def days_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """All days from ``start`` to ``end``, both included, as ``day``."""
    days = F.sequence(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(days).alias("day"))


@dataclass
class Ledger:
    """Finished units of work, in the folder ``path``."""

    spark: SparkSession
    path: str

    def history(self) -> DataFrame:
        """Every row ever written: ``stage``, ``country``, ``day``, ``done`` and ``at`` (nanoseconds)."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    def finished(self) -> DataFrame:
        """Units whose latest row says that they are done, with the time ``at``."""
        last = F.max_by("done", "at")
        found = self.history().groupBy(*UNIT).agg(last.alias("done"), F.max("at").alias("at"))
        return found.where("done").drop("done")

    def pending(self, stage: str, country: str, days: DataFrame) -> DataFrame:
        """The days that are not finished."""
        done = self.finished().where((F.col("stage") == stage) & (F.col("country") == country))
        return days.distinct().join(done.select("day"), "day", "left_anti")

    def finish(self, stage: str, country: str, days: DataFrame) -> None:
        self._append(stage, country, days, True)

    def strike(self, stage: str, country: str, days: DataFrame) -> None:
        """Take days back, to be done anew by the next run."""
        self._append(stage, country, days, False)

    def _append(self, stage: str, country: str, days: DataFrame, done: bool) -> None:
        days.select(
            F.lit(stage).alias("stage"),
            F.lit(country).alias("country"),
            "day",
            F.lit(done).alias("done"),
            F.lit(time.time_ns()).alias("at"),
        ).coalesce(1).write.mode("append").parquet(self.path)


def ranges(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Sorted days as ranges without gaps."""
    found: list[tuple[dt.date, dt.date]] = []
    for day in days:
        if found and day - found[-1][1] == dt.timedelta(days=1):
            found[-1] = (found[-1][0], day)
        else:
            found.append((day, day))
    return found


def resume(
    spark: SparkSession,
    pings_path: str,
    states: DataFrame,
    out_path: str,
    ledger: Ledger,
    start: dt.date,
    end: dt.date,
    country: str = "US",
    timezones: DataFrame | None = None,
    stages: tuple[str, ...] = STAGES,
    most_days: int = 31,
    **options,
) -> list[tuple[str, dt.date, dt.date]]:
    """Do what is left of the stages ``stops``, ``hours`` and ``places`` from ``start`` to ``end``.

    Tables are written below ``out_path``: ``stops`` and ``hours`` by day, where a day's rows replace those
    of an earlier run, and ``visits`` and ``places``, which follow users over all days. They are made anew
    whenever stops were written since. Neighbouring days are one job, of at most ``most_days``. A unit is
    entered after its rows are written. Returns the stages and ranges of days that were worked on.

    Only days come to the driver, one for each unit of the range.
    """
    unknown = set(stages) - set(STAGES)
    if unknown or ("places" in stages and timezones is None):
        raise ValueError(f"unknown stages {sorted(unknown)}" if unknown else "places need time zones")
    wanted, worked = days_between(spark, start, end), []

    def left(stage: str) -> list[tuple[dt.date, dt.date]]:
        days = [r["day"] for r in ledger.pending(stage, country, wanted).orderBy("day").collect()]
        parts = [days[i : i + most_days] for i in range(0, len(days), most_days)]
        return [r for part in parts for r in ranges(part)]

    for stage in (s for s in ("stops", "hours") if s in stages):
        for first, last in left(stage):
            if stage == "stops":
                mobility.backfill(spark, pings_path, states, f"{out_path}/stops", first, last, **options)
            else:
                pings = scan_date_range(spark, pings_path, first, last)
                sinks.write_bin_hours(activity.bin_hours(pings), f"{out_path}/hours", by_prefix=False)
            ledger.finish(stage, country, days_between(spark, first, last))
            worked.append((stage, first, last))
    if "places" in stages:
        own = ledger.finished().where(F.col("country") == country)
        stops_at = own.where((F.col("stage") == "stops")).agg(F.max("at")).first()[0]
        places_at = own.where((F.col("stage") == "places") & (F.col("day") >= F.lit(end))).agg(F.max("at")).first()[0]
        if stops_at is not None and (places_at is None or places_at < stops_at):
            located = mobility.located_stops(
                scan_table(spark, f"{out_path}/stops"), timezones
            )
            mobility.write_visits_and_places(located, f"{out_path}/visits", f"{out_path}/places")
            ledger.finish("places", country, days_between(spark, end, end))
            worked.append(("places", end, end))
    return worked
