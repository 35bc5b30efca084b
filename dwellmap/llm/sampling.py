"""Bounded samples for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_share(*columns: str) -> Column:
    """A hash of the columns as a number from 0 to 1."""
    hashed = F.shiftrightunsigned(F.xxhash64(*columns), 1)
    return hashed.cast("double") / F.lit(2.0**63)


def hash_sample(df: DataFrame, columns: list[str], wanted: int) -> DataFrame:
    """At most ``wanted`` rows, those with the least hashes of ``columns``; of equal rows one.

    The number of different hashes is estimated first, so a value that makes up most of the table takes one
    place and doesn't push out the others. Rows whose hash is too large to matter are then filtered out where
    they are read, so a task passes on about four times its share of the sample, whatever the size of the
    table. Adds the column ``h``.
    """
    hashed = df.withColumn("h", hash_share(*columns))
    different = hashed.agg(F.approx_count_distinct("h")).first()[0]
    near = hashed.where(F.col("h") <= min(1.0, 4 * wanted / max(different, 1)))
    return near.dropDuplicates(["h"]).orderBy("h").limit(wanted)


def hash_sample_by(
    df: DataFrame, key: str, columns: list[str], wanted: int, least: int
) -> tuple[DataFrame, dict[object, int]]:
    """The same for every value of ``key``, of which there must be few: about ``wanted`` rows in all, shared
    out by the numbers of different rows, but at least ``least`` for each. Also returns these numbers."""
    hashed = df.withColumn("h", hash_share(*columns))
    found = hashed.groupBy(key).agg(F.approx_count_distinct("h").alias("n")).collect()
    sizes = {r[key]: r["n"] for r in found}
    total = max(1, sum(sizes.values()))
    own = {k: max(least, wanted * n // total) for k, n in sizes.items()}
    if not sizes:
        return hashed, sizes
    limits = F.create_map(*[F.lit(v) for k in sizes for v in (k, min(1.0, 4 * own[k] / max(sizes[k], 1)))])
    most = F.create_map(*[F.lit(v) for k in sizes for v in (k, own[k])])
    near = hashed.where(F.col("h") <= limits[F.col(key)]).dropDuplicates([key, "h"])
    place = F.row_number().over(Window.partitionBy(key).orderBy("h"))
    return near.withColumn("__place", place).where(F.col("__place") <= most[F.col(key)]).drop("__place"), sizes
