"""Stage tables bucketed by user.

Stages that follow a user over many days (merging, repair, clustering) need a user's rows together. Stops are
written once so that every file holds whole users in order of time; stages that read such a table go on
without moving rows. The number of buckets and the order stand beside the data, so a table is always opened
as it was written.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

USER_COLUMN = "userId"
_LAYOUT = "_layout"


def write_user_table(
    df: DataFrame, path: str, buckets: int, order: tuple[str, ...] = ("begin", "end")
) -> DataFrame:
    """Write ``df`` to the new folder ``path`` in ``buckets`` buckets of users, sorted by user and ``order``,
    and return the table. A bucket should hold some 256 MB; all users with no id share one.
    """
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        raise ValueError(f"{path} exists")
    name = _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.repartition(buckets, USER_COLUMN)
        .write.format("parquet")
        .bucketBy(buckets, USER_COLUMN)
        .sortBy(USER_COLUMN, *order)
        .option("path", path)
        .saveAsTable(name)
    )
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    layout = spark.createDataFrame([(buckets, list(order), columns)], "buckets int, order array<string>, columns string")
    layout.coalesce(1).write.parquet(f"{path}/{_LAYOUT}")
    return spark.table(name)


def open_user_table(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``write_user_table`` wrote, perhaps in another session."""
    layout = spark.read.parquet(f"{path}/{_LAYOUT}").first()
    name = _name(path)
    order = ", ".join(f"`{c}`" for c in (USER_COLUMN, *layout["order"]))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({layout['columns']}) USING parquet "
        f"CLUSTERED BY ({USER_COLUMN}) SORTED BY ({order}) INTO {layout['buckets']} BUCKETS "
        f"LOCATION '{path}'"
    )
    return spark.table(name)


def _name(path: str) -> str:
    return "user_table_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()
