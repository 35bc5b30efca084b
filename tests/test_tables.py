"""Reading and writing: layouts, pruning, overwriting, compaction, ingest."""

import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from dwellmap import schemas
from dwellmap.checks import fixtures
from dwellmap.operators import activity, ingest, places
from dwellmap.plans import mobility
from dwellmap.sources import sinks, tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stops(spark):
    return mobility.user_stops(fixtures.pings(spark, SF_DIR), fixtures.states(spark)).cache()


def same(a, b):
    columns = sorted(a.columns)
    assert sorted(b.columns) == columns
    text = [F.col(c).cast("string") for c in columns]
    a, b = a.select(*text), b.select(*text)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stop_layout_and_reading_back(spark, stops, tmp_path):
    path = str(tmp_path / "stops")
    sinks.write_stops(stops, path, by_prefix=True)
    back = tables.scan_table(spark, path)
    assert same(back, sinks.with_day_columns(stops))
    assert dict(back.dtypes)["prefix"] == "string"
    assert glob.glob(f"{path}/year=2024/month=1/day=5/prefix=*/state=*/part-*.snappy.parquet")
    files = glob.glob(f"{path}/*/*/*/*/*/part-*.parquet")
    assert len(files) == len({os.path.dirname(f) for f in files}), "one file per small partition"


def test_scans_prune_partitions(spark, stops, tmp_path, capsys):
    path = str(tmp_path / "stops")
    sinks.write_stops(stops, path)
    one = tables.scan_partition(spark, path, year=2024, month=1, day=5)
    days = tables.scan_date_range(spark, path, "2024-01-05", dt.date(2024, 1, 6))
    state = tables.scan_state(spark, path, "NJ")
    assert one.select("day").distinct().collect() == [("5",)]
    assert sorted(r.day for r in days.select("day").distinct().collect()) == ["5", "6"]
    assert state.count() == stops.where("state = 'NJ'").count()
    for frame, word in ((one, "day"), (days, "make_date"), (state, "state")):
        frame.explain("formatted")
        line = next(x for x in capsys.readouterr().out.splitlines() if x.startswith("PartitionFilters"))
        assert word in line
    assert tables.scan_date_range(spark, path, "2023-01-01", "2023-12-31").isEmpty()
    paths = [f"{path}/year=2024/month=1/day={d}" for d in (5, 6)]
    assert same(tables.read_many(spark, paths, root=path), days)


def test_rewriting_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "hours")
    hours = activity.bin_hours(fixtures.pings(spark, SF_DIR)).cache()
    sinks.write_bin_hours(hours, path)
    again = hours.where("dayofyear = 3").withColumn("num_hours", F.lit(99))
    sinks.write_bin_hours(again, path)
    back = tables.scan_table(spark, path)
    assert same(back, hours.where("dayofyear <> 3").unionByName(again))


def test_visit_and_place_layouts(spark, stops, tmp_path):
    located = mobility.located_stops(stops, fixtures.timezones(spark)).cache()
    visits, kept = places.visits(located), places.places(located)
    mobility.write_visits_and_places(located, str(tmp_path / "visits"), str(tmp_path / "places"))
    assert same(tables.scan_table(spark, str(tmp_path / "visits")), visits)
    assert same(tables.scan_table(spark, str(tmp_path / "places")), kept)
    sinks.write_visits(visits, str(tmp_path / "by_day"), layout="day")
    assert glob.glob(f"{tmp_path}/by_day/prefix=*/year=2024/dayofyear=5/*.parquet")
    sinks.write_places(kept.withColumn("year", F.lit(2024)), str(tmp_path / "by_year"), layout="year")
    assert glob.glob(f"{tmp_path}/by_year/prefix=*/year=2024/*.parquet")


def test_compaction(spark, tmp_path):
    rows = [("a", 1, "x", 1), ("a", 1, "y", 2), ("b", 1, "x", 1), ("c", 2, "z", 1)]
    frame = spark.createDataFrame(rows, "key string, day int, note string, turn int")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    frame.repartition(4).write.partitionBy("turn").parquet(source)
    frame.coalesce(1).write.parquet(str(tmp_path / "other"))
    stray = glob.glob(f"{tmp_path}/other/part-*.parquet")[0]
    with open(stray, "rb") as f, open(f"{source}/turn=1/copy.parquet", "wb") as g:
        g.write(f.read())
    sinks.compact_table(spark, source, target, ("day",), ("key",), ("turn",), compression="gzip")
    back = tables.scan_table(spark, target).orderBy("key").collect()
    assert [(r.key, r.day, r.note, r.turn) for r in back] == [("a", "1", "x", "1"), ("b", "1", "x", "1"), ("c", "2", "z", "1")]
    assert len(glob.glob(f"{target}/day=*/part-*.gz.parquet")) == 2
    none = str(tmp_path / "none")
    frame.where("false").write.parquet(none)
    with pytest.raises(Exception, match="no rows|Unable to infer|empty"):
        sinks.compact_table(spark, none, str(tmp_path / "out2"), ("day",), allow_empty=False)


def test_compaction_bounds_the_rows_of_a_task(spark, tmp_path, monkeypatch, capsys):
    """Rows are dealt out before they are first sorted, and by more partitions where there are more rows."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5000).selectExpr("id % 2000 AS key", "id AS turn", "id % 3 AS day").coalesce(1).write.parquet(source)
    write = sinks.write_table
    monkeypatch.setattr(sinks, "_ROWS_PER_PARTITION", 100, raising=False)
    monkeypatch.setattr(sinks, "write_table", lambda df, *a: df.explain() or write(df, *a))
    sinks.compact_table(spark, source, target, ("day",), ("key",), ("turn",))
    plan = capsys.readouterr().out
    dealt = re.search(r"hashpartitioning\(key#\d+L, turn#\d+L, day#\d+L, 50\), REBALANCE_PARTITIONS_BY_COL", plan)
    assert dealt and dealt.start() > plan.index("row_number(), 1, Partial")
    assert re.search(r"hashpartitioning\(key#\d+L, 50\), ENSURE_REQUIREMENTS", plan)
    assert initial not in spark.conf.getAll
    kept = tables.scan_table(spark, target).select("key", "turn", F.col("day").cast("int"))
    assert sorted(map(tuple, kept.collect())) == [(i, i, i % 3) for i in range(2000)]


@pytest.mark.parametrize("chosen, during", [("9", "50"), ("80", "80")])
def test_partitions_chosen_by_the_session_are_kept(spark, chosen, during, monkeypatch):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(sinks, "_ROWS_PER_PARTITION", 100)
    spark.conf.set(initial, chosen)
    try:
        with sinks._enough_tasks(spark, 4901):
            assert spark.conf.get(initial) == during
        assert spark.conf.get(initial) == chosen
    finally:
        spark.conf.unset(initial)


def test_backfill_touches_only_its_days(spark, stops, tmp_path):
    pings, target = str(tmp_path / "pings"), str(tmp_path / "stops")
    dated = fixtures.pings(spark, SF_DIR).withColumn("process_day", F.to_date("timestamp"))
    sinks.write_table(sinks.with_day_columns(dated), pings, ("year", "month", "day"))
    days = dt.date(2024, 1, 5), dt.date(2024, 1, 8)
    mobility.backfill(spark, pings, fixtures.states(spark), target, *days)
    wanted = stops.where(F.col("process_day").between(*[F.lit(d) for d in days]))
    assert same(tables.scan_table(spark, target), sinks.with_day_columns(wanted).drop("prefix"))
    pending = sinks.pending_partitions(
        tables.scan_table(spark, pings).select("year", "month", "day"),
        sinks.written_partitions(spark, target, ("year", "month", "day")),
    )
    assert sorted(int(r.day) for r in pending.collect()) == [d for d in range(1, 31) if not 5 <= d <= 8]


def test_backfill_of_one_country(spark, stops, tmp_path):
    pings, target = str(tmp_path / "pings"), str(tmp_path / "stops")
    dated = fixtures.pings(spark, SF_DIR).withColumn("process_day", F.to_date("timestamp"))
    for country in ("US", "IT"):
        sinks.write_table(
            sinks.with_day_columns(dated), pings, ("year", "month", "day"), within={"country": country}
        )
    days = dt.date(2024, 1, 5), dt.date(2024, 1, 6)
    mobility.backfill(spark, pings, fixtures.states(spark), target, *days, country="IT")
    assert os.listdir(target + "/country=IT") == ["year=2024"]
    wanted = stops.where(F.col("process_day").between(*[F.lit(d) for d in days]))
    assert tables.scan_table(spark, target).count() == wanted.count()


def test_ingest_limits(spark, tmp_path):
    day = int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp())
    good = ["aa11", "1", "40.5", "-75.5", "12.5", "-18000", "OTHER", ""]
    cases = {
        "kept": [day], "latest": [day + 86400], "too new": [day + 86401],
        "oldest": [day - 30 * 86400], "too old": [day - 30 * 86400 - 1],
    }
    lines = ["\t".join([str(epoch), name, *good[1:]]) for name, (epoch,) in cases.items()]
    lines += ["\t".join([str(day), f"acc{a}", *good[1:4], a, *good[5:]]) for a in ("300", "300.0", "300.9", "x", "")]
    lines += ["\t".join([str(day), "odd device", "big", *good[2:]]), "\t".join(["junk", *good])]
    (tmp_path / "day").mkdir()
    (tmp_path / "day" / "part-0.tsv").write_text("\n".join(lines) + "\n")
    raw = tables.scan_tsv(spark, str(tmp_path / "day"), "2024-03-01")
    rows = {r.userId: r for r in ingest.ingest(raw, "IT").collect()}
    assert set(rows) == {"kept", "latest", "oldest", "acc300", "acc300.0", "odd device"}
    assert rows["odd device"].device is None
    kept = rows["kept"]
    assert (kept.timestamp, kept.accuracy, kept.offset, kept.source) == (dt.datetime(2024, 3, 1), 12.5, -18000, "pings_IT_20240301")
    assert (kept.year, kept.month, kept.day, kept.prefix) == (2024, 3, 1, "ke")
    (stats,) = ingest.ingest_stats(raw, "IT").collect()
    assert tuple(stats) == ("pings_IT_20240301", 12, 6)


def test_run_ingest_writes_table_and_counts(spark, tmp_path):
    raw = fixtures.raw(spark, SF_DIR).where("delivery_day <= '2024-01-03'")
    sinks.run_ingest(raw, str(tmp_path / "delivered"), str(tmp_path / "stats"), files=4)
    assert glob.glob(f"{tmp_path}/delivered/delivery_day=2024-01-02/year=2024/month=1/day=1/prefix=*/*.parquet")
    stats = spark.read.schema(schemas.INGEST_STATS).option("header", True).csv(str(tmp_path / "stats"))
    assert stats.agg(F.sum("count_line_output")).first()[0] == tables.scan_table(spark, str(tmp_path / "delivered")).count()


@pytest.mark.parametrize("case", ["once", "added twice", "nothing kept"])
def test_ingest_counts_on_the_way_to_the_writer(spark, tmp_path, monkeypatch, case):
    raw = fixtures.raw(spark, SF_DIR).where("delivery_day <= '2024-01-03'")
    raw.write.partitionBy("delivery_day").option("sep", "\t").csv(str(tmp_path / "raw"))
    scan = tables.scan_tsv(spark, str(tmp_path / "raw"))
    limits = {"max_accuracy": -100.0} if case == "nothing kept" else {}
    want = sorted(tuple(r) for r in ingest.ingest_stats(scan, **limits).collect())
    recounted = []
    monkeypatch.setattr(sinks, "ingest_stats", lambda *a, **k: recounted.append(1) or ingest.ingest_stats(*a, **k))
    if case == "added twice":
        counters = sinks._counters
        monkeypatch.setattr(sinks, "_counters", lambda *a: [(2 * c).alias(f"{s} {d}") for c, (s, d) in zip(
            counters(*a), [(s, d) for s in ("in", "out") for d in a[0]])])
    sinks.run_ingest(scan, str(tmp_path / "out"), str(tmp_path / "stats"), by_prefix=False, files=2, **limits)
    stats = spark.read.schema(schemas.INGEST_STATS).option("header", True).csv(str(tmp_path / "stats")).collect()
    assert sorted(tuple(r)[:3] for r in stats) == want and len(want) > 1
    assert all(r.end_time > r.start_time for r in stats)
    assert bool(recounted) == (case == "added twice")


def test_first_delivery_wins_within_the_window(spark):
    rows = [("a", "2024-01-05 10:00:00", 1.0, f"2024-{d}", d) for d in ("01-03", "01-04", "01-05", "02-04", "02-05")]
    rows += [("b", "2024-01-05 10:00:00", 1.0, "2024-02-05", "late"), ("a", "2024-01-05 10:00:00", 2.0, "2024-01-09", "other")]
    frame = spark.createDataFrame(rows, "userId string, timestamp string, accuracy double, delivery_day string, note string")
    frame = frame.withColumns({"timestamp": F.to_timestamp("timestamp"), "delivery_day": F.to_date("delivery_day")})
    kept = ingest.consolidate_deliveries(frame).orderBy("accuracy").collect()
    assert [(r.userId, r.accuracy, r.note) for r in kept] == [("a", 1.0, "01-04"), ("a", 2.0, "other")]


def test_first_rows_of_tables_with_odd_column_names(spark):
    frame = spark.range(6).selectExpr("id % 2 AS key", "id AS turn", "id AS `a note`", "-id AS `1-2`")
    kept = ingest.keep_first(frame, ("key",), "turn")
    assert sorted(map(tuple, kept.collect())) == [(0, 0, 0, 0), (1, 1, 1, -1)]


def test_top_rank_is_limited_before_the_shuffle(spark, capsys):
    ingest.consolidate_deliveries(fixtures.delivered(spark, SF_DIR)).explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit (") >= 2


def test_bin_hours_shuffles_once(spark, capsys):
    activity.bin_hours(fixtures.pings(spark, SF_DIR), accuracy=60).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


def test_shared_dir_is_the_one_the_session_names(spark):
    from dwellmap.session import shared_dir

    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())


def test_many_small_partitions_are_written_by_many_tasks(spark, tmp_path):
    """Small tables too, with one file each, and the session's settings as before."""
    size = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    rows = spark.range(20_000).selectExpr("id", "id % 200 AS part")
    sinks.write_table(rows, str(tmp_path / "t"), ("part",), unit=1)
    files = list((tmp_path / "t").glob("part=*/part-*.parquet"))
    assert len(files) == 200
    assert len({f.name.split("-")[1] for f in files}) > 4
    assert size not in spark.conf.getAll
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000
