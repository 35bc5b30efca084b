"""Hours of the day in which a user was seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmap.operators.trajectory import ACCURACY_M, accuracy_filter


def bin_hours(pings: DataFrame, accuracy: float = ACCURACY_M) -> DataFrame:
    """Number of distinct UTC hours with a ping, per user and day.

    The hours are collected in the bits of one integer, so map tasks reduce a user-day to a single
    row before the only shuffle and no distinct aggregation is needed.
    """
    hour_bit = F.call_function("shiftleft", F.lit(1), F.hour("timestamp"))
    return (
        accuracy_filter(pings, accuracy)
        .groupBy("userId", F.to_date("timestamp").alias("date"))
        .agg(F.bit_count(F.bit_or(hour_bit)).cast("int").alias("num_hours"))
        .select(
            "userId",
            "num_hours",
            F.substring("userId", 1, 2).alias("prefix"),
            F.year("date").alias("year"),
            F.dayofyear("date").alias("dayofyear"),
        )
    )
