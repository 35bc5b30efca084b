"""Every operator as a query over the given tables, in the form its oracle can be compared with."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellmap import schemas
from dwellmap.checks import fixtures
from dwellmap.functions.geo import geohash
from dwellmap.functions.tables import register_stop_function
from dwellmap.operators import activity, clustering, ingest, merging, places, proximity, stops, trajectory
from dwellmap.plans import ledger, mobility
from dwellmap.session import materialise, prepare, scratch_path
from dwellmap.sources import screening, sinks, tables, user_tables

_METRES = {
    "distance", "distance_next", "distance_prev", "dist_sum", "after_stop_distance", "pair_sum_m",
    "diameter_m", "prev_travelled_distance", "next_travelled_distance", "nearest_m",
}
_DEGREES = {
    "latitude", "longitude", "clusterLatitude", "clusterLongitude", "medoid_lat", "medoid_lon",
}


# Means often end in an exact half of the last digit, where the order of additions would decide.
_OFF_HALF = 3e-11


def comparable(df: DataFrame, *columns: str) -> DataFrame:
    """Times as microseconds, dates as text, distances to the millimetre, positions to 9 decimals."""
    shown = []
    for field in (df.select(*columns) if columns else df).schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif field.name in _METRES:
            column = F.round(column, 3)
        elif field.name in _DEGREES:
            column = F.round(column + _OFF_HALF, 9)
        shown.append(column.alias(field.name))
    return df.select(*shown)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(*columns: str):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(prepare(spark), sf_dir), *columns)

        _QUERIES[build.__name__] = run
        return build

    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


_PING = ("timestamp", "userId", "latitude", "longitude", "accuracy")
_TYPED = (
    *_PING, "device", "offset", "opt1", "opt2", "source", "year", "month", "day", "prefix", "delivery_day",
)
_STOP = (
    "process_day", "userId", "latitude", "longitude", "begin", "end", "personal_area", "geohash6",
    "prev_travelled_distance", "after_stop_distance", "next_travelled_distance",
)
_MERGED = ("userId", "state", "latitude", "longitude", "begin", "end")
_STOP_KEY = ("process_day", "userId", "chunk", "serial")
_YMD = ("year", "month", "day")


# --- stages the queries share --------------------------------------------------------------------


def _thinned(spark, sf_dir):
    pings = trajectory.accuracy_filter(fixtures.pings(spark, sf_dir))
    return trajectory.minute_dedup(trajectory.select_ping_columns(pings))


def _steps(spark, sf_dir):
    return trajectory.step_distance(trajectory.user_days(fixtures.pings(spark, sf_dir)))


def _tracks(spark, sf_dir):
    return mobility.tracks(fixtures.pings(spark, sf_dir))


def _stops(spark, sf_dir):
    return mobility.user_stops(fixtures.pings(spark, sf_dir), fixtures.states(spark))


def _stop_table(spark, sf_dir):
    """Stops as a stage boundary: later stages read them more than once."""
    return materialise(_stops(spark, sf_dir))


def _repaired(spark, sf_dir):
    return merging.repair_overlaps(merging.merge_stops(_stop_table(spark, sf_dir)))


def _located(spark, sf_dir, version=6):
    return mobility.located_stops(
        _stop_table(spark, sf_dir), fixtures.timezones(spark), version=version
    )


def _by_day(pings):
    return sinks.with_day_columns(pings.withColumn("process_day", F.to_date("timestamp")))


def _ping_table(spark, sf_dir):
    """Pings written by day, as the partition scans read them."""
    path = scratch_path(spark, "pings")
    sinks.write_table(_by_day(fixtures.pings(spark, sf_dir)), path, _YMD)
    return path


def _raw_files(spark, sf_dir):
    """Deliveries written as tab-separated files, one folder per delivery day."""
    path = scratch_path(spark, "raw")
    raw = fixtures.raw(spark, sf_dir).hint("rebalance", "delivery_day")
    raw.write.partitionBy("delivery_day").option("sep", "\t").csv(path)
    return path


# --- sources -------------------------------------------------------------------------------------


@_query()
def scan_tsv(spark, sf_dir):
    return tables.scan_tsv(spark, _raw_files(spark, sf_dir))


@_query(*_PING, *_YMD, "prefix")
def scan_partition(spark, sf_dir):
    return tables.scan_partition(spark, _ping_table(spark, sf_dir), year=2024, month=1, day=9)


@_query(*_PING, *_YMD, "prefix")
def scan_date_range(spark, sf_dir):
    return tables.scan_date_range(spark, _ping_table(spark, sf_dir), "2024-01-05", "2024-01-20")


@_query(*_STOP, "state")
def scan_state(spark, sf_dir):
    path = scratch_path(spark, "stops")
    sinks.write_table(_stops(spark, sf_dir), path, ("state",))
    return tables.scan_state(spark, path, "NJ")


@_query()
def lookup_states(spark, sf_dir):
    seen = fixtures.keyed_pings(spark, sf_dir).select(
        geohash("latitude", "longitude", 5).alias("geohash"),
        F.when(F.col("event_id") % 2 == 0, "PA")
        .when(F.col("latitude") < 40.1, "NJ")
        .otherwise("NY")
        .alias("STUSPS"),
    )
    return stops.lookup_states(seen)


# --- ingest and consolidation --------------------------------------------------------------------


@_query(*_TYPED)
def ingest_project(spark, sf_dir):
    return ingest.ingest_project(fixtures.raw(spark, sf_dir))


@_query()
def ingest_filter(spark, sf_dir):
    return ingest.ingest_filter(fixtures.raw(spark, sf_dir))


@_query(*_TYPED)
def ingest_deliveries(spark, sf_dir):
    return ingest.ingest(tables.scan_tsv(spark, _raw_files(spark, sf_dir)))


_QUERIES["ingest"] = _QUERIES.pop("ingest_deliveries")


@_query()
def ingest_stats(spark, sf_dir):
    return ingest.ingest_stats(fixtures.raw(spark, sf_dir))


@_query()
def ingest_run(spark, sf_dir):
    """Counts and times of an ingest, from the file it leaves."""
    delivered, stats = scratch_path(spark, "delivered"), scratch_path(spark, "stats")
    raw = tables.scan_tsv(spark, _raw_files(spark, sf_dir))
    sinks.run_ingest(raw, delivered, stats, by_prefix=False)
    read = spark.read.schema(schemas.INGEST_STATS).option("header", True).csv(stats)
    timed = (F.col("end_time") > F.col("start_time")).alias("timed")
    return read.select("table_name", "count_line_input", "count_line_output", timed)


@_query(*_PING, "source", *_YMD, "prefix", "delivery_day")
def write_delivered(spark, sf_dir):
    path = scratch_path(spark, "delivered")
    delivered = ingest.ingest(fixtures.raw(spark, sf_dir))
    sinks.write_delivered(delivered, path, by_prefix=False)
    return tables.scan_table(spark, path)


@_query(*_PING, "opt1")
def consolidate_deliveries(spark, sf_dir):
    return ingest.consolidate_deliveries(fixtures.delivered(spark, sf_dir))


@_query()
def pending_partitions(spark, sf_dir):
    prefix = F.substring("userId", 1, 2).alias("prefix")
    wanted = fixtures.pings(spark, sf_dir).select(F.to_date("timestamp").alias("day"), prefix)
    existing = _stops(spark, sf_dir).select(F.col("process_day").alias("day"), prefix)
    return sinks.pending_partitions(wanted, existing)


@_query()
def pending_from_listing(spark, sf_dir):
    """Days and user prefixes with pings for which no stops are written, told by the names of files.

    The folders are those asked about; states, which would make three times as many, stay in the files."""
    path = scratch_path(spark, "stops")
    sinks.write_table(sinks.with_day_columns(_stops(spark, sf_dir)), path, sinks.PING_PARTITIONS, unit=3)
    written = sinks.written_partitions(spark, path, sinks.PING_PARTITIONS)
    prefix = F.substring("userId", 1, 2).alias("prefix")
    wanted = fixtures.pings(spark, sf_dir).select(F.to_date("timestamp").alias("day"), prefix)
    return sinks.pending_partitions(
        wanted, written.select(tables.partition_date().alias("day"), "prefix")
    )


@_query()
def screened_scan(spark, sf_dir):
    """Deliveries in compressed files among which empty, cut and foreign ones stand."""
    path = scratch_path(spark, "raw")
    raw = fixtures.raw(spark, sf_dir).hint("rebalance", "delivery_day")
    raw.write.partitionBy("delivery_day").option("sep", "\t").option("compression", "gzip").csv(path)
    fixtures.spoil(spark, path)
    good = screening.sound_paths(screening.screen_files(spark, path, "*.gz"))
    reader = spark.read.schema(schemas.RAW + ", delivery_day date").option("basePath", path)
    return reader.option("sep", "\t").csv(good)


@_query(*_PING, "opt1", *_YMD)
def compact_table(spark, sf_dir):
    path_in, path_out = scratch_path(spark, "delivered"), scratch_path(spark, "compacted")
    delivered = fixtures.delivered(spark, sf_dir).where(ingest.in_delivery_window())
    sinks.write_table(delivered, path_in, ("delivery_day",))
    sinks.compact_table(
        spark, path_in, path_out, _YMD, ingest.DEDUP_COLUMNS, ("delivery_day",), allow_empty=False
    )
    return tables.scan_table(spark, path_out)


@_query(*_STOP[1:], "state", *_YMD)
def compact_stops(spark, sf_dir):
    path_in, path_out = scratch_path(spark, "stops"), scratch_path(spark, "compacted")
    sinks.write_table(
        sinks.with_day_columns(_stops(spark, sf_dir)), path_in, ("prefix", "state")
    )
    sinks.compact_table(spark, path_in, path_out, (*_YMD, "state"))
    return tables.scan_table(spark, path_out)


@_query()
def compact_bin_hours(spark, sf_dir):
    path_in, path_out = scratch_path(spark, "hours"), scratch_path(spark, "compacted")
    sinks.write_table(activity.bin_hours(fixtures.pings(spark, sf_dir)), path_in, ("prefix",))
    sinks.compact_table(spark, path_in, path_out, ("year", "dayofyear"))
    return tables.scan_table(spark, path_out)


# --- trajectories --------------------------------------------------------------------------------


@_query(*_PING)
def accuracy_filter(spark, sf_dir):
    return trajectory.accuracy_filter(fixtures.pings(spark, sf_dir))


@_query("timestamp", "userId", "personal_area")
def personal_area_flag(spark, sf_dir):
    return trajectory.select_ping_columns(fixtures.pings(spark, sf_dir))


@_query(*_PING, "personal_area")
def minute_dedup(spark, sf_dir):
    return _thinned(spark, sf_dir)


@_query(*_PING, "process_day")
def union_overlap(spark, sf_dir):
    return trajectory.union_overlap(fixtures.pings(spark, sf_dir))


@_query(*_PING, "process_day")
def process_day_expand(spark, sf_dir):
    return trajectory.process_day_expand(_thinned(spark, sf_dir))


@_query("process_day", "userId", "timestamp", "distance_next", "distance_prev")
def step_distance(spark, sf_dir):
    return _steps(spark, sf_dir)


@_query("process_day", "userId", "timestamp", "chunk")
def chunks(spark, sf_dir):
    return trajectory.chunks(_steps(spark, sf_dir))


@_query("process_day", "userId", "timestamp", "chunk")
def chunk_day_filter(spark, sf_dir):
    return trajectory.chunk_day_filter(trajectory.chunks(_steps(spark, sf_dir)))


@_query()
def trajectories(spark, sf_dir):
    micros = F.transform("gpsdata", lambda p: F.unix_micros(p["timestamp"]).cast("string"))
    return _tracks(spark, sf_dir).select(
        *_STOP_KEY[:3],
        "dist_sum",
        F.size("gpsdata").alias("n"),
        F.array_join(micros, ",").alias("times"),
    )


# --- stops ---------------------------------------------------------------------------------------


@_query(*_STOP_KEY, "n_pairs", "pair_sum_m")
def pairwise_distance(spark, sf_dir):
    return stops.stop_geometry(_tracks(spark, sf_dir))


@_query(*_STOP_KEY, "diameter_m")
def stop_diameter(spark, sf_dir):
    return stops.stop_diameters(_tracks(spark, sf_dir))


@_query(*_STOP_KEY, "medoid_lat", "medoid_lon")
def stop_medoid(spark, sf_dir):
    found = stops.detect_stops(_tracks(spark, sf_dir), center="medoid").where("serial IS NOT NULL")
    return trajectory.to_degrees(found).withColumnsRenamed(
        {"latitude": "medoid_lat", "longitude": "medoid_lon"}
    )


@_query(
    *_STOP_KEY, "latitude", "longitude", "begin", "end", "personal_area", "distance", "geohash6",
    "after_stop_distance", "dist_sum",
)
def detect_stops(spark, sf_dir):
    return trajectory.to_degrees(stops.detect_stops(_tracks(spark, sf_dir)))


@_query(
    *_STOP_KEY, "latitude", "longitude", "begin", "end", "personal_area", "distance", "geohash6",
    "after_stop_distance", "dist_sum",
)
def detect_stops_sql(spark, sf_dir):
    """Stop detection as a table function in SQL, over single pings."""
    register_stop_function(spark)
    pings = trajectory.chunk_day_filter(trajectory.chunks(_steps(spark, sf_dir)))
    found = spark.sql(
        """
        SELECT *, degrees(latitude) AS lat, degrees(longitude) AS lon, timestamp_micros(begin_us) AS begin,
          timestamp_micros(end_us) AS end
        FROM detect_stops(TABLE(
          SELECT * FROM {pings} DISTRIBUTE BY process_day, userId SORT BY process_day, userId, chunk, timestamp))
        """,
        pings=pings,
    )
    return found.withColumns(
        {"latitude": F.col("lat"), "longitude": F.col("lon"), "geohash6": geohash("lat", "lon", 6)}
    )


@_query(*_STOP)
def travelled_distance(spark, sf_dir):
    return stops.travelled_distance(stops.detect_stops(_tracks(spark, sf_dir)))


@_query(*_STOP, "state")
def stops_with_state(spark, sf_dir):
    return _stops(spark, sf_dir)


@_query(*_STOP[1:], "prefix", "state", *_YMD)
def write_stops(spark, sf_dir):
    path = scratch_path(spark, "stops")
    sinks.write_stops(_stops(spark, sf_dir), path)
    read = tables.scan_table(spark, path)
    return read.withColumn("prefix", F.substring("userId", 1, 2))


@_query(*_STOP[1:], "prefix", "state", *_YMD)
def backfill(spark, sf_dir):
    path = scratch_path(spark, "stops")
    mobility.backfill(
        spark,
        _ping_table(spark, sf_dir),
        fixtures.states(spark),
        path,
        dt.date(2024, 1, 5),
        dt.date(2024, 1, 20),
    )
    read = tables.scan_table(spark, path)
    return read.withColumn("prefix", F.substring("userId", 1, 2))


@_query()
def resumed_backfill(spark, sf_dir):
    """Two runs over eight days, with one day of stops struck out in between: how often each unit was done,
    and the rows it has in the end."""
    out, days = scratch_path(spark, "backfill"), (dt.date(2024, 1, 5), dt.date(2024, 1, 12))
    done = ledger.Ledger(spark, f"{out}/ledger")
    struck = dt.date(2024, 1, 8)
    pings = _ping_table(spark, sf_dir)
    for run in range(2):
        if run:
            done.strike("stops", "US", ledger.days_between(spark, struck, struck))
        ledger.resume(
            spark, pings, fixtures.states(spark), out, done, *days, stages=("stops", "hours")
        )
    runs = done.history().groupBy("stage", "day").agg(F.count_if("done").alias("runs"))
    hours = tables.scan_table(spark, f"{out}/hours")
    dated = hours.select(F.make_date(F.col("year").cast("int"), F.lit(1), F.lit(1)).alias("first"), "dayofyear")
    rows = (
        tables.scan_table(spark, f"{out}/stops")
        .select(F.lit("stops").alias("stage"), tables.partition_date().alias("day"))
        .unionByName(
            dated.select(
                F.lit("hours").alias("stage"),
                F.date_add("first", F.col("dayofyear").cast("int") - 1).alias("day"),
            )
        )
        .groupBy("stage", "day")
        .agg(F.count("*").alias("n_rows"))
    )
    return runs.join(rows, ["stage", "day"], "left").fillna(0, ["n_rows"])


@_query()
def near_points(spark, sf_dir):
    """For every ping, the users who start within 1 500 m of it, and the nearest."""
    pings = fixtures.keyed_pings(spark, sf_dir)
    starts = pings.groupBy("userId").agg(
        F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude")
    )
    keyed = pings.withColumn("ping", F.col("event_id") * 6 + F.col("k"))
    return proximity.near_points(keyed, starts, 1500, "ping", "userId", cell_limit=2)


# --- activity hours ------------------------------------------------------------------------------


@_query()
def bin_hours(spark, sf_dir):
    return activity.bin_hours(fixtures.pings(spark, sf_dir))


@_query()
def write_bin_hours(spark, sf_dir):
    path = scratch_path(spark, "hours")
    hours = activity.bin_hours(fixtures.pings(spark, sf_dir))
    sinks.write_bin_hours(hours, path, by_prefix=False)
    return tables.scan_table(spark, path)


# --- places --------------------------------------------------------------------------------------


@_query("userId", "begin", "end", "distance_prev", "opens_group")
def merge_flag(spark, sf_dir):
    return merging.merge_flag(_stop_table(spark, sf_dir))


@_query(*_MERGED)
def merge_stops(spark, sf_dir):
    return merging.merge_stops(_stop_table(spark, sf_dir))


@_query(*_MERGED)
def merge_stops_by_state(spark, sf_dir):
    return merging.merge_stops(_stop_table(spark, sf_dir), by_state=True)


@_query(*_MERGED)
def merge_stops_v3(spark, sf_dir):
    return merging.merge_stops(_stop_table(spark, sf_dir), by_state=True, day_rule="later")


@_query(*_MERGED)
def repair_overlaps(spark, sf_dir):
    return _repaired(spark, sf_dir)


@_query(*_MERGED)
def merge_border_stops(spark, sf_dir):
    """Groups that lie across a state border are split there."""
    return merging.merge_stops(fixtures.border_stops(spark, sf_dir), by_state=True)


@_query(*_MERGED)
def repair_border_stops(spark, sf_dir):
    """Groups that reach into the next one are cut."""
    return merging.repair_overlaps(merging.merge_stops(fixtures.border_stops(spark, sf_dir)))


@_query(*_MERGED)
def user_table_merge(spark, sf_dir):
    """Merging and repair on a table bucketed by user, opened anew."""
    path = scratch_path(spark, "user-stops")
    user_tables.write_user_table(_stops(spark, sf_dir), path, buckets=8)
    kept = user_tables.open_user_table(spark, path)
    return merging.repair_overlaps(merging.merge_stops(kept, together=True), together=True)


@_query(*_MERGED, "clusterId")
def cluster_places(spark, sf_dir):
    return clustering.cluster_places(_repaired(spark, sf_dir))


@_query(*_MERGED, "clusterId")
def cluster_places_large(spark, sf_dir):
    """Every group through the way meant for users too large for one task."""
    return clustering.cluster_places(_repaired(spark, sf_dir), group_limit=0)


@_query()
def cluster_centroids(spark, sf_dir):
    return places.cluster_centroids(clustering.cluster_places(_repaired(spark, sf_dir)))


@_query()
def geohash_cells(spark, sf_dir):
    lengths = {f"geohash{n}": geohash("latitude", "longitude", n) for n in (5, 6, 7)}
    return fixtures.pings(spark, sf_dir).withColumns(lengths).select("userId", "timestamp", *lengths)


_QUERIES["geohash"] = _QUERIES.pop("geohash_cells")


@_query("userId", "state", "clusterId", "begin", "tzid", "offset", "geohash7")
def local_offset(spark, sf_dir):
    return _located(spark, sf_dir)


@_query()
def visits(spark, sf_dir):
    return places.visits(_located(spark, sf_dir))


@_query()
def visits_v3(spark, sf_dir):
    return places.visits(_located(spark, sf_dir, version=3))


@_query()
def visits_all_zones(spark, sf_dir):
    """Places outside the time-zone lookup are kept, without an offset."""
    stops_in = _stop_table(spark, sf_dir)
    return places.visits(mobility.located_stops(stops_in, fixtures.timezones(spark), how="left"))


@_query()
def places_table(spark, sf_dir):
    return places.places(_located(spark, sf_dir))


_QUERIES["places"] = _QUERIES.pop("places_table")


@_query()
def places_distinct(spark, sf_dir):
    return places.places_distinct(_located(spark, sf_dir, version=5))


@_query()
def places_by_year(spark, sf_dir):
    merged = merging.merge_stops(_stop_table(spark, sf_dir), by_state=True, day_rule="later")
    return places.places_by_year(clustering.cluster_places(merged))


def _written(spark, sf_dir):
    paths = scratch_path(spark, "visits"), scratch_path(spark, "places")
    mobility.write_visits_and_places(_located(spark, sf_dir), *paths)
    return paths


@_query()
def write_visits(spark, sf_dir):
    return tables.scan_table(spark, _written(spark, sf_dir)[0], schema=schemas.VISITS)


@_query()
def write_places(spark, sf_dir):
    return tables.scan_table(spark, _written(spark, sf_dir)[1], schema=schemas.PLACES)


@_query()
def rewrite_places(spark, sf_dir):
    """Places written twice: what the first run put into other states is gone after the second."""
    path = scratch_path(spark, "places")
    table = materialise(places.places(_located(spark, sf_dir)))
    sinks.write_places(table.withColumn("state", F.lit("XX")), path)
    sinks.write_places(table, path)
    return tables.scan_table(spark, path)


@_query(*_STOP[1:], "prefix", "state", *_YMD)
def rewrite_stops(spark, sf_dir):
    """Stops of all days written twice, first with wrong states."""
    path = scratch_path(spark, "stops")
    table = _stop_table(spark, sf_dir)
    sinks.write_stops(table.withColumn("state", F.concat("state", F.lit("2"))), path)
    sinks.write_stops(table, path)
    read = tables.scan_table(spark, path)
    return read.withColumn("prefix", F.substring("userId", 1, 2))
