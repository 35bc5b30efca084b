"""Partitioned writers, compaction, and what is still to be done."""

from __future__ import annotations

import contextlib
import datetime as dt
import re
import time
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dwellmap.operators.ingest import ingest, ingest_condition, ingest_stats, keep_first, source_tag
from dwellmap.sources.tables import scan_table

PING_PARTITIONS = ("year", "month", "day", "prefix")
STOP_PARTITIONS = ("year", "month", "day", "prefix", "state")
BIN_HOUR_PARTITIONS = ("year", "dayofyear", "prefix")
VISIT_PARTITIONS = ("prefix",)
VISIT_DAY_PARTITIONS = ("prefix", "year", "dayofyear")
PLACE_PARTITIONS = ("prefix", "state")
PLACE_YEAR_PARTITIONS = ("prefix", "year")
COMPRESSION = "snappy"
_TASK_SIZE = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_ROWS_PER_PARTITION = 1_000_000


def write_table(
    df: DataFrame,
    path: str,
    partitions: tuple[str, ...],
    compression: str = COMPRESSION,
    files: int | None = None,
    within: dict[str, str] | None = None,
    unit: int = 0,
) -> None:
    """Write a Hive-partitioned Parquet table, replacing only what has new rows.

    Rows are rebalanced by partition: a small one becomes a single file, and one that holds much
    of the data is split over several tasks and files. ``files`` instead merges to at most that many
    tasks. ``within`` puts the table below fixed partitions, such as ``{"country": "US"}``.

    A partition with new rows is overwritten. With ``unit``, the first so many partition columns name
    the unit of work, such as a day: all partitions of a unit that has new rows are replaced, also
    those that no longer get any, so a rerun on changed input leaves no stale rows.
    """
    for name, value in (within or {}).items():
        df = df.withColumn(name, F.lit(value))
    partitions = (*(within or {}), *partitions)
    laid_out = df.coalesce(files) if files else df.hint("rebalance", *partitions)
    before = _leaf_files(df.sparkSession, path) if unit else {}
    with _small_tasks(df.sparkSession):
        (
            laid_out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", compression)
            .partitionBy(*partitions)
            .parquet(path)
        )
    # A table that had no files holds nothing stale.
    if before:
        _drop_stale(df.sparkSession, before, _leaf_files(df.sparkSession, path), len(partitions), len(within or {}) + unit)


@contextlib.contextmanager
def _small_tasks(spark: SparkSession) -> Iterator[None]:
    """Let small rebalanced tables be written by as many tasks as run at once, not by one per MB: with thousands of
    partitions the files take longer than the rows. A partition's rows stay together, so there are no more files."""
    chosen = _TASK_SIZE in spark.conf.getAll
    if not chosen:
        spark.conf.set(_TASK_SIZE, "1k")
    try:
        yield
    finally:
        if not chosen:
            spark.conf.unset(_TASK_SIZE)


@contextlib.contextmanager
def _enough_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """Let shuffles start with a partition for so many rows at least, so tasks don't grow with the table. Spark merges
    small ones as before."""
    chosen = spark.conf.get(_INITIAL_PARTITIONS, None)
    wanted = -(-rows // _ROWS_PER_PARTITION)
    raised = wanted > int(chosen or spark.conf.get("spark.sql.shuffle.partitions"))
    if raised:
        spark.conf.set(_INITIAL_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        if raised and chosen is None:
            spark.conf.unset(_INITIAL_PARTITIONS)
        elif raised:
            spark.conf.set(_INITIAL_PARTITIONS, chosen)


def _leaf_files(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """Data files of a table by folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, set[str]] = {}
    if fs.exists(root):
        files = fs.listFiles(root, True)
        while files.hasNext():
            file = files.next().getPath()
            if file.getName().startswith("part-"):
                found.setdefault(file.getParent().toString(), set()).add(file.getName())
    return found


def _drop_stale(
    spark: SparkSession, before: dict[str, set[str]], after: dict[str, set[str]], depth: int, unit: int
) -> None:
    """Delete the folders that the last write left alone in units it wrote to."""

    def unit_of(folder: str) -> tuple[str, ...]:
        return tuple(folder.split("/")[-depth:][:unit])

    fresh = {f for f, files in after.items() if files - before.get(f, set())}
    touched = {unit_of(f) for f in fresh}
    for folder in after.keys() - fresh:
        if unit_of(folder) in touched:
            stale = spark._jvm.org.apache.hadoop.fs.Path(folder)
            stale.getFileSystem(spark._jsc.hadoopConfiguration()).delete(stale, True)


def with_day_columns(df: DataFrame, day: str = "process_day") -> DataFrame:
    """Add the partition columns of a dated table."""
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "day": F.dayofmonth(day),
            "prefix": F.substring("userId", 1, 2),
        }
    ).drop(day)


def write_delivered(
    delivered: DataFrame, path: str, files: int | None = None, by_prefix: bool = True, **options
) -> None:
    """One folder per delivery day, then by event day and, unless switched off, by user prefix.

    Prefixes make thousands of folders per delivery; leave them out where no reader picks users.
    """
    partitions = tuple(p for p in PING_PARTITIONS if by_prefix or p != "prefix")
    write_table(delivered, path, ("delivery_day", *partitions), files=files, **{"unit": 1} | options)


def write_pings(pings: DataFrame, path: str, **options) -> None:
    """Consolidated pings by event day and prefix; a day is written as a whole."""
    write_table(pings, path, PING_PARTITIONS, **{"unit": 3} | options)


def write_stops(stops: DataFrame, path: str, by_prefix: bool = False, **options) -> None:
    """Stops by process day and state; by user prefix as well if readers want to pick users.

    With prefixes there are 256 times as many folders, so leave them out for long histories. A day is
    written as a whole; pass ``unit=0`` to write some users of a day only.
    """
    partitions = tuple(p for p in STOP_PARTITIONS if by_prefix or p != "prefix")
    dated = with_day_columns(stops)
    write_table(
        dated if by_prefix else dated.drop("prefix"), path, partitions, **{"unit": 3} | options
    )


def write_bin_hours(hours: DataFrame, path: str, by_prefix: bool = True, **options) -> None:
    """Activity hours by day and, unless switched off, by user prefix."""
    partitions = tuple(p for p in BIN_HOUR_PARTITIONS if by_prefix or p != "prefix")
    write_table(hours, path, partitions, **{"unit": 2} | options)


def write_visits(visits: DataFrame, path: str, layout: str = "prefix", **options) -> None:
    """Visits by prefix, or with ``layout="day"`` also by day of the year."""
    write_table(
        visits,
        path,
        VISIT_DAY_PARTITIONS if layout == "day" else VISIT_PARTITIONS,
        **{"unit": 1} | options,
    )


def write_places(places: DataFrame, path: str, layout: str = "state", **options) -> None:
    """Places by prefix and state, or with ``layout="year"`` by prefix and year."""
    write_table(
        places,
        path,
        PLACE_YEAR_PARTITIONS if layout == "year" else PLACE_PARTITIONS,
        **{"unit": 1} | options,
    )


def compact_table(
    spark: SparkSession,
    path_in: str,
    path_out: str,
    partitions: tuple[str, ...],
    dedup_columns: tuple[str, ...] = (),
    dedup_order: tuple[str, ...] = (),
    compression: str = COMPRESSION,
    allow_empty: bool = True,
) -> None:
    """Rewrite a table with one Parquet file per (small) target partition.

    Columns that only lived in the source's folder names are kept as data. With ``dedup_columns``
    the first row per key stays, in ``dedup_order`` and then by all other columns.
    """
    table = scan_table(spark, path_in, part_files_only=True)
    with contextlib.ExitStack() as stack:
        if dedup_columns:
            # No column is asked for, so the count reads no more than the footers.
            stack.enter_context(_enough_tasks(spark, table.count()))
            table = keep_first(table, dedup_columns, *dedup_order)
        write_table(table, path_out, partitions, compression)
    if not allow_empty and scan_table(spark, path_out).isEmpty():
        raise ValueError(f"compaction of {path_in} produced no rows")


def written_partitions(spark: SparkSession, path: str, partitions: tuple[str, ...]) -> DataFrame:
    """Partitions a table has files in, from the names of its files: no file is opened. Files without a byte,
    as a failed write may leave, don't count; Spark's scans leave them out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(*partitions).distinct()


def pending_partitions(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Wanted partitions that have not been written yet, to skip the finished ones on a rerun."""
    return wanted.distinct().join(existing.distinct(), wanted.columns, "left_anti")


def _days_of_files(raw: DataFrame) -> list[str]:
    """Delivery days of a scan, from the names of its folders."""
    found = (re.search(r"/delivery_day=(\d{4}-\d\d-\d\d)/", file) for file in raw.inputFiles())
    return sorted({day[1] for day in found if day})


def _counters(days: list[str], kept: Column) -> list[Column]:
    """How many rows of each delivery came in, and how many of these are kept."""
    of_day = [(day, F.col("delivery_day") == F.lit(day).cast("date")) for day in days]
    return [
        F.count_if(here & also).alias(f"{side} {day}")
        for side, also in (("in", F.lit(True)), ("out", kept))
        for day, here in of_day
    ]


def run_ingest(
    raw: DataFrame,
    path_out: str,
    stats_path: str,
    country: str = "US",
    files: int | None = None,
    by_prefix: bool = True,
    **limits,
) -> None:
    """Ingest raw deliveries, write the delivered table, and a CSV with the row counts.

    The raw text is read once: rows are counted as they pass on the way to the writer. As tasks that run
    again may add to such counts twice, the rows kept are compared with what the footers of the written files
    say; where they differ, all is counted anew by a scan. A raw table that wasn't read from folders named
    by delivery day is counted by a scan as well.
    """
    days = _days_of_files(raw)
    kept = F.coalesce(ingest_condition(**limits), F.lit(False))
    counts = Observation()
    counted = raw.observe(counts, *_counters(days, kept)) if days else raw
    started = time.time()
    write_delivered(ingest(counted, country, **limits), path_out, files=files, by_prefix=by_prefix)
    ended = time.time()
    stats = _counted_stats(raw.sparkSession, path_out, days, counts.get, country) if days else None
    if stats is None:
        stats = ingest_stats(raw, country, **limits)
    stats = stats.withColumns({"start_time": F.lit(started), "end_time": F.lit(ended)})
    stats.coalesce(1).write.mode("overwrite").option("header", True).csv(stats_path)


def _counted_stats(
    spark: SparkSession, path: str, days: list[str], counts: dict[str, int], country: str
) -> DataFrame | None:
    """The counts per delivery, None where the rows counted as kept are not those written."""
    kept = {day: counts[f"out {day}"] for day in days if counts[f"out {day}"]}
    folders = [f"{path.rstrip('/')}/delivery_day={day}" for day in kept]
    # Only partition columns are asked for, so Spark reads no more than the footers.
    written = spark.read.option("basePath", path).parquet(*folders).groupBy("delivery_day").count() if kept else None
    if written is not None and {str(r[0]): r[1] for r in written.collect()} != kept:
        return None
    rows = [(dt.date.fromisoformat(day), counts[f"in {day}"], counts[f"out {day}"]) for day in days]
    counted = spark.createDataFrame(rows, "delivery_day date, count_line_input long, count_line_output long")
    return counted.select(source_tag(country).alias("table_name"), "count_line_input", "count_line_output")
