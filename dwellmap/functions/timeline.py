"""Neighbour rows and running totals along a user's time line, safe for users with huge histories.

A window over one user sorts that user's whole history in one task. Here the history is cut into
time spans; rows look at their neighbours inside the span, and one summary row per span carries
the value over the boundary. Only the summaries (one per user and span) are windowed per user.
A detected stop lasts minutes and stops of a day do not overlap, so a span of 28 days holds some
8 000 stops of a user at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = "span"
SPAN_DAYS = 28
_NO_TIME = -(1 << 62)


def by_span(df: DataFrame, keys: list[str], time_column: str, days: int = SPAN_DAYS) -> DataFrame:
    """Number the time span of each row and bring the rows of every key and span together.

    Rows without a time come first, in a span of their own. Rows without a key are on no one's time
    line and are left out.
    """
    span = F.floor(F.unix_seconds(time_column) / F.lit(days * 86400)).cast("long")
    known = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    spans = df.withColumn(SPAN, F.coalesce(span, F.lit(_NO_TIME)))
    return spans.where(known).repartition(*keys, SPAN)


def with_neighbour(
    df: DataFrame, keys: list[str], order: list[str], name: str, following: bool = False
) -> DataFrame:
    """Add the previous (or following) row of the same keys as struct ``name``.

    The struct holds the whole row: the summary and the rows then need the same columns, so Spark
    shuffles ``df`` once and uses the shuffle for both.
    """
    row, rank = F.struct(*[c for c in df.columns if c not in (*keys, SPAN)]), F.struct(*order)
    step = F.lead if following else F.lag
    edge = F.min_by(row, rank) if following else F.max_by(row, rank)
    inside = Window.partitionBy(*keys, SPAN).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(SPAN)
    carried = (
        df.groupBy(*keys, SPAN)
        .agg(edge.alias("edge"))
        .select(*keys, SPAN, step("edge").over(across).alias("carried"))
    )
    return (
        df.withColumn(name, step(row).over(inside))
        .join(carried, [*keys, SPAN], "left")
        .withColumn(name, F.coalesce(name, "carried"))
        .drop("carried")
    )


def with_neighbour_together(
    df: DataFrame, keys: list[str], order: list[str], name: str, following: bool = False
) -> DataFrame:
    """The same for rows whose keys stand together already, as in a table bucketed by them: no row moves.

    A window over the whole history of a key takes the place of spans. Its task spills, so memory stays
    bounded, but a key's history is one task's work. Rows without a key are left out.
    """
    row = F.struct(*[c for c in df.columns if c not in keys])
    step = F.lead if following else F.lag
    known = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return df.where(known).withColumn(name, step(row).over(Window.partitionBy(*keys).orderBy(*order)))


def with_running_total_together(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str
) -> DataFrame:
    """``with_running_total`` for rows whose keys stand together already."""
    frame = (Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rangeBetween(*frame)))


def with_running_total(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str
) -> DataFrame:
    """Add the running total of ``value`` up to and including rows equal in ``order``."""
    frame = (Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy(*keys, SPAN).orderBy(*order).rangeBetween(*frame)
    before = Window.partitionBy(*keys).orderBy(SPAN).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        df.groupBy(*keys, SPAN)
        .agg(F.sum(value).alias("total"))
        .select(*keys, SPAN, F.sum("total").over(before).alias("carried"))
    )
    return (
        df.withColumn(name, F.sum(value).over(inside))
        .join(carried, [*keys, SPAN], "left")
        .withColumn(name, F.col(name) + F.coalesce("carried", F.lit(0)))
        .drop("carried")
    )
