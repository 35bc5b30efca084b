"""Raw location files to typed pings, and consolidation of late deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ACCURACY_M = 300
PRIOR_DAYS = 30
AFTER_DAYS = 1
CONSOLIDATE_DAYS_BEFORE = 1
CONSOLIDATE_DAYS_AFTER = 30
DEDUP_COLUMNS = ("timestamp", "userId", "accuracy")


def source_tag(country: str) -> Column:
    """Name of the delivery a row came in, e.g. ``pings_US_20200911``."""
    return F.concat(F.lit(f"pings_{country}_"), F.date_format("delivery_day", "yyyyMMdd"))


def _number(name: str, to: str) -> Column:
    """Parse a raw string as a number; decimals are cut off for whole types, junk becomes null."""
    return F.col(name).try_cast("double").try_cast(to)


def ingest_project(raw: DataFrame, country: str = "US") -> DataFrame:
    """Name and type the raw string columns; a value that does not parse becomes null."""
    at = F.timestamp_seconds(_number("_c0", "bigint"))
    return raw.select(
        at.alias("timestamp"),
        F.col("_c1").alias("userId"),
        _number("_c2", "tinyint").alias("device"),
        _number("_c3", "double").alias("latitude"),
        _number("_c4", "double").alias("longitude"),
        _number("_c5", "double").alias("accuracy"),
        _number("_c6", "int").alias("offset"),
        F.col("_c7").alias("opt1"),
        F.col("_c8").alias("opt2"),
        source_tag(country).alias("source"),
        F.year(at).alias("year"),
        F.month(at).alias("month"),
        F.dayofmonth(at).alias("day"),
        F.substring("_c1", 1, 2).alias("prefix"),
        F.col("delivery_day"),
    )


def ingest_condition(
    max_accuracy: float = MAX_ACCURACY_M, prior_days: int = PRIOR_DAYS, after_days: int = AFTER_DAYS
) -> Column:
    """Rows ingest keeps: accurate enough, and seen in the window around the delivery day.

    Works on the raw strings, so the filter sits directly above the scan.
    """
    epoch = _number("_c0", "double")
    midnight = F.unix_seconds(F.col("delivery_day").cast("timestamp"))
    return (_number("_c5", "double") <= max_accuracy) & epoch.between(
        midnight - prior_days * 86400, midnight + after_days * 86400
    )


def ingest_filter(raw: DataFrame, **limits) -> DataFrame:
    """Drop malformed, inaccurate and out-of-window raw rows."""
    return raw.where(ingest_condition(**limits))


def ingest(raw: DataFrame, country: str = "US", **limits) -> DataFrame:
    """Raw rows with their ``delivery_day`` to delivered pings; narrow, no shuffle."""
    return ingest_project(ingest_filter(raw, **limits), country)


def ingest_stats(raw: DataFrame, country: str = "US", **limits) -> DataFrame:
    """Rows in and rows kept per delivery, counted in one scan.

    The counts come from an aggregate and not from an observed metric, because retried tasks may
    add to a metric twice.
    """
    kept = F.coalesce(ingest_condition(**limits), F.lit(False))
    return raw.groupBy(source_tag(country).alias("table_name")).agg(
        F.count(F.lit(1)).alias("count_line_input"),
        F.count_if(kept).alias("count_line_output"),
    )


def in_delivery_window(
    days_before: int = CONSOLIDATE_DAYS_BEFORE, days_after: int = CONSOLIDATE_DAYS_AFTER
) -> Column:
    """Deliveries that count for an event: from the day before it to ``days_after`` days later."""
    event_day = F.to_date("timestamp")
    return F.col("delivery_day").between(
        F.date_sub(event_day, days_before), F.date_add(event_day, days_after)
    )


def consolidate_deliveries(
    delivered: DataFrame,
    days_before: int = CONSOLIDATE_DAYS_BEFORE,
    days_after: int = CONSOLIDATE_DAYS_AFTER,
    dedup_columns: tuple[str, ...] = DEDUP_COLUMNS,
) -> DataFrame:
    """One row per dedup key, from its earliest delivery; all event days in one job."""
    wanted = delivered.where(in_delivery_window(days_before, days_after))
    return keep_first(wanted, dedup_columns, "delivery_day").drop("delivery_day")


def keep_first(df: DataFrame, keys: tuple[str, ...] | list[str], *order: str) -> DataFrame:
    """First row per key in the given order, then by every other column so reruns agree.

    Spark limits each group before the shuffle as well, so copies of one key never pile up. That takes a sort of all
    rows of a task, so they are first dealt out, by all columns, to tasks of bounded size: a split of a well
    compressed table holds many millions.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    rank = Window.partitionBy(*keys).orderBy(*order, *rest)
    dealt = df.hint("rebalance", *map(F.col, df.columns))
    return dealt.withColumn("rank", F.row_number().over(rank)).where("rank = 1").drop("rank")
