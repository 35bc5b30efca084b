"""Mobility inputs derived by Spark from the ``events`` table, which carries no coordinates itself.

Every derivation is plain arithmetic over all events, so DuckDB can build identical rows
(``oracles.py``) and the inputs grow with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Region of each geohash cell the derived pings fall in, and the cells' time zones.
STATE_CELLS = {
    "PA": ["dr4ec", "dr4ed", "dr4ee", "dr4ef", "dr4eg"],
    "NJ": ["dr4eg", "dr4es", "dr4et", "dr4eu", "dr4ev"],
    "NY": ["dr4s1", "dr4s3", "dr4s4", "dr4s5", "dr4s6", "dr4s7", "dr4sh", "dr4sj", "dr4sk"],
}
ZONE_CELLS = {
    "America/New_York": ["dr4ec", "dr4ed", "dr4ee", "dr4ef"],
    "America/St_Johns": ["dr4eg", "dr4es", "dr4et", "dr4eu", "dr4ev"],
    "Asia/Kolkata": ["dr4s1", "dr4s3", "dr4s4", "dr4s5", "dr4s6", "dr4s7", "dr4sh", "dr4sj"],
}


def _values(pairs: dict[str, list[str]]) -> str:
    return ", ".join(f"('{name}', '{cell}')" for name, cells in pairs.items() for cell in cells)


def states(spark: SparkSession) -> DataFrame:
    """State lookup; one cell is listed twice and one is missing on purpose."""
    return spark.sql(f"SELECT * FROM VALUES {_values(STATE_CELLS)} AS t(STUSPS, geohash)")


def timezones(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {_values(ZONE_CELLS)} AS t(tzid, geohash5)")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def keyed_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six pings per event, 150 seconds apart, with the event they came from."""
    at = F.col("ts").cast("timestamp")
    user, event, k = F.col("user_id"), F.col("event_id"), F.col("k")
    place = (user * 7 + F.floor(F.unix_seconds(at) / 43200)) % 3
    drift = (
        F.when(F.col("event_type") == "error", 0.002)
        .when(F.col("event_type") == "signup", 0.0003)
        .when(F.col("event_type") == "purchase", 0.0005)
        .otherwise(0.00002)
    )
    base = F.lit(40.0) + (user % 15) * F.lit(0.01) + place * F.lit(0.005) + (event % 5) * F.lit(0.00005)
    # What an event's pings share is worked out once, before there are six of them.
    shared = _events(spark, sf_dir).select(
        "event_id",
        at.alias("at"),
        F.lower(F.lpad(F.hex((user * 2654435761) % 4294967296), 8, "0")).alias("userId"),
        base.alias("base"),
        drift.alias("drift"),
        (F.lit(-75.0) - (user % 10) * F.lit(0.02)).alias("longitude"),
        F.when(place == 0, "PERSONAL_AREA").otherwise("OTHER").alias("opt1"),
        F.date_add(F.to_date(at), (event % 4).cast("int")).alias("delivery_day"),
    )
    return shared.select("*", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k")).select(
        "event_id",
        "k",
        (F.col("at") + F.make_dt_interval(secs=k * 150)).alias("timestamp"),
        "userId",
        F.lit(1).cast("tinyint").alias("device"),
        (F.col("base") + k * F.col("drift")).alias("latitude"),
        "longitude",
        ((event * 37 + k * 11) % 110 - 5).cast("double").alias("accuracy"),
        F.lit(-18000).alias("offset"),
        "opt1",
        F.lit(None).cast("string").alias("opt2"),
        F.lit("pings").alias("source"),
        "delivery_day",
    )


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_pings(spark, sf_dir).drop("event_id", "k", "delivery_day")


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings by delivery; some come again a day later, changed, and some far too late as well."""
    every = keyed_pings(spark, sf_dir)
    copies = F.array_compact(
        F.array(
            F.struct("delivery_day", "opt1"),
            F.when(
                F.col("event_id") % 10 == 0,
                F.struct(F.date_add("delivery_day", 1).alias("delivery_day"), F.lit("LATE").alias("opt1")),
            ),
            F.when(
                F.col("event_id") % 50 == 0,
                F.struct(F.date_add(F.to_date("timestamp"), 31).alias("delivery_day"), F.lit("TOO_LATE").alias("opt1")),
            ),
        )
    )
    return (
        every.withColumn("copy", F.explode(copies))
        .drop("delivery_day", "opt1", "event_id", "k")
        .select("*", "copy.*")
        .drop("copy")
        .withColumns(
            {
                "year": F.year("timestamp"),
                "month": F.month("timestamp"),
                "day": F.dayofmonth("timestamp"),
                "prefix": F.substring("userId", 1, 2),
            }
        )
    )


def border_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stop per event, a few minutes after the user's last one: groups of four lie across a state border, and
    every seventh stop is so long that it reaches into the next group."""
    turn = F.floor(F.col("event_id") / 50)
    walked = [F.when(n % 4 == 0, 30.0).otherwise(0.0) for n in (turn, turn + 1)]
    begin = F.lit("2024-02-01").cast("timestamp") + F.make_dt_interval(
        secs=(turn * 540 + (turn * turn) % 5 * 60).cast("decimal(18,6)")
    )
    minutes = F.when(turn % 7 == 0, 70).otherwise(4 + turn % 3)
    return _events(spark, sf_dir).select(
        F.format_string("user%02d", F.col("event_id") % 50).alias("userId"),
        F.when(turn % 3 == 0, "NJ").otherwise("PA").alias("state"),
        (F.lit(40.0) + F.floor(turn / 4) % 9 * 0.001 + turn % 4 * 0.00001).alias("latitude"),
        F.lit(-75.0).alias("longitude"),
        begin.alias("begin"),
        (begin + F.make_dt_interval(mins=minutes.cast("int"))).alias("end"),
        walked[0].alias("prev_travelled_distance"),
        walked[1].alias("next_travelled_distance"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings as the strings of a delivery file, with malformed, inaccurate and stale rows added."""
    first = F.col("k") == 0
    # An event adds at most one row, so every case is an array of its own and nothing need be filtered.
    kind: Column = F.array(F.lit("good"))
    for digit, added in ((3, "malformed"), (5, "inaccurate"), (7, "stale")):
        both = F.array(F.lit("good"), F.lit(added))
        kind = F.when(first & (F.col("event_id") % 10 == digit), both).otherwise(kind)
    epoch = F.unix_seconds("timestamp") - F.when(F.col("kind") == "stale", 40 * 86400).otherwise(0)
    accuracy = (
        F.when(F.col("kind") == "malformed", "x")
        .when(F.col("kind") == "inaccurate", "300.9")
        .otherwise(F.col("accuracy").cast("int").cast("string"))
    )
    return (
        keyed_pings(spark, sf_dir)
        .withColumn("kind", F.explode(kind))
        .select(
            epoch.cast("string").alias("_c0"),
            F.col("userId").alias("_c1"),
            F.col("device").cast("string").alias("_c2"),
            # Six digits, as a format would give them, at a fraction of its time.
            F.col("latitude").cast("decimal(12,6)").cast("string").alias("_c3"),
            F.col("longitude").cast("decimal(12,6)").cast("string").alias("_c4"),
            accuracy.alias("_c5"),
            F.col("offset").cast("string").alias("_c6"),
            F.col("opt1").alias("_c7"),
            F.lit(None).cast("string").alias("_c8"),
            "delivery_day",
        )
    )


def spoil(spark: SparkSession, path: str) -> None:
    """Put an empty file, the first half of a good one and a text without compression beside the compressed
    files of a folder."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.gz")
    # Only names and lengths come to the driver; the half is copied from stream to stream.
    good = listed.load(path).select("path", "length").orderBy(F.desc("length"), "path").first()
    folder = good["path"].rpartition("/")[0]
    jvm = spark._jvm
    store = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for name, data in (("empty", b""), ("cut", None), ("foreign", b"1\t2\n" * 9)):
        out = store.create(jvm.org.apache.hadoop.fs.Path(f"{folder}/part-{name}.csv.gz"))
        if data is None:
            source = store.open(jvm.org.apache.hadoop.fs.Path(good["path"]))
            jvm.org.apache.commons.io.IOUtils.copyLarge(source, out, 0, good["length"] // 2)
            source.close()
        else:
            out.write(bytearray(data))
        out.close()
