"""Readers for the files and partitioned tables the stages exchange.

Paths may use any file system Spark can reach; Spark lists, prunes and splits the files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmap import schemas


def scan_tsv(spark: SparkSession, path: str, delivery_day: str | None = None) -> DataFrame:
    """Headerless tab-separated deliveries, all columns as strings, plus their ``delivery_day``.

    ``path`` is either one delivery, whose day is then given, or a folder of
    ``delivery_day=YYYY-MM-DD`` folders, of which Spark reads only the wanted ones.
    """
    if delivery_day:
        raw = spark.read.schema(schemas.RAW).option("sep", "\t").csv(path)
        return raw.withColumn("delivery_day", F.to_date(F.lit(delivery_day)))
    schema = schemas.RAW + ", delivery_day date"
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def scan_table(
    spark: SparkSession, path: str, part_files_only: bool = False, schema: str | None = None
) -> DataFrame:
    """A Hive-partitioned Parquet table; ``part_files_only`` skips files not named ``part-*.parquet``.

    With a ``schema``, such as those of ``dwellmap.schemas``, columns have its types instead of those
    found in the first file, and no file has to be opened to plan the scan.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    if part_files_only:
        reader = reader.option("pathGlobFilter", "part-*.parquet")
    return reader.parquet(path)


def scan_partition(spark: SparkSession, path: str, **values: int | str) -> DataFrame:
    """Partitions of a table with the given values, e.g. ``year=2020, month=9``.

    Partition columns come back as strings, so hex prefixes keep their leading zeros; the filter
    is resolved against the folder names.
    """
    table = scan_table(spark, path)
    for name, value in values.items():
        table = table.where(F.col(name) == F.lit(str(value)))
    return table


def partition_date() -> Column:
    """Date of a year/month/day partition; comparing it prunes partitions."""
    return F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])


def scan_date_range(
    spark: SparkSession, path: str, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    """Days from ``start`` to ``end``, both included; days without data are simply empty."""
    return scan_table(spark, path).where(
        partition_date().between(F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end))))
    )


def read_many(
    spark: SparkSession, paths: list[str], root: str | None = None, format: str = "parquet"
) -> DataFrame:
    """Several paths as one table, in one scan; below ``root``, folder names become columns."""
    reader = spark.read.format(format)
    if root:
        reader = reader.option("basePath", root)
    return reader.load(paths)


def scan_state(spark: SparkSession, path: str, state: str) -> DataFrame:
    """Rows of one state; prunes folders when the table is partitioned by state."""
    return scan_table(spark, path).where(F.col("state") == state)
