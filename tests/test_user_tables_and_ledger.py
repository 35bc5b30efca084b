"""Tables bucketed by user, and backfills that go on where they stopped."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dwellmap.checks import fixtures
from dwellmap.operators import merging
from dwellmap.plans import ledger, mobility
from dwellmap.sources import sinks, user_tables
from dwellmap.sources.tables import scan_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stops(spark):
    return mobility.user_stops(fixtures.pings(spark, SF_DIR), fixtures.states(spark)).cache()


def rows(df):
    return sorted(map(str, df.collect()))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange")


def test_merging_reads_a_user_table_without_moving_rows(spark, stops, tmp_path):
    path = str(tmp_path / "stops")
    user_tables.write_user_table(stops, path, buckets=4)
    spark.sql(f"DROP TABLE {user_tables._name(path)}")
    table = user_tables.open_user_table(spark, path)
    assert rows(table) == rows(stops.select(table.columns))
    for options in ({}, {"by_state": True}, {"day_rule": "later"}):
        merged = merging.merge_stops(table, together=True, **options)
        repaired = merging.repair_overlaps(merged, together=True)
        assert exchanges(repaired) == 0
        assert rows(repaired) == rows(merging.repair_overlaps(merging.merge_stops(stops, **options)))
    with pytest.raises(ValueError, match="exists"):
        user_tables.write_user_table(stops, path, buckets=2)


def test_rows_without_user_and_empty_tables(spark, stops, tmp_path):
    odd = stops.limit(3).withColumn("userId", F.lit(None).cast("string"))
    table = user_tables.write_user_table(stops.unionByName(odd), str(tmp_path / "a"), buckets=3)
    assert table.count() == stops.count() + odd.count()
    assert rows(merging.merge_stops(table, together=True)) == rows(merging.merge_stops(stops))
    none = user_tables.write_user_table(stops.limit(0), str(tmp_path / "b"), buckets=3)
    assert merging.repair_overlaps(merging.merge_stops(none, together=True), together=True).collect() == []


def test_ranges_of_days():
    d = [dt.date(2024, 2, n) for n in (1, 2, 3, 7, 9, 10)]
    assert ledger.ranges(d) == [(d[0], d[2]), (d[3], d[3]), (d[4], d[5])]
    assert ledger.ranges([]) == []


def test_a_run_does_only_what_is_left(spark, stops, tmp_path):
    pings, out = str(tmp_path / "pings"), str(tmp_path / "out")
    dated = fixtures.pings(spark, SF_DIR).withColumn("process_day", F.to_date("timestamp"))
    sinks.write_table(sinks.with_day_columns(dated), pings, ("year", "month", "day"))
    days = dt.date(2024, 1, 5), dt.date(2024, 1, 8)
    book = ledger.Ledger(spark, f"{out}/ledger")
    zones = fixtures.timezones(spark)

    def run(**options):
        return ledger.resume(
            spark, pings, fixtures.states(spark), out, book, *days, timezones=zones, **options
        )

    assert run(stages=("stops",), most_days=3) == [
        ("stops", days[0], dt.date(2024, 1, 7)), ("stops", days[1], days[1])
    ]
    assert run() == [("hours", *days), ("places", days[1], days[1])]
    assert run() == []
    wanted = stops.where(F.col("process_day").between(*[F.lit(d) for d in days]))
    written = scan_table(spark, f"{out}/stops")
    assert rows(written.select("userId", "begin", "end")) == rows(wanted.select("userId", "begin", "end"))
    places = rows(scan_table(spark, f"{out}/places"))
    book.strike("stops", "US", ledger.days_between(spark, dt.date(2024, 1, 6), dt.date(2024, 1, 6)))
    assert run() == [("stops", dt.date(2024, 1, 6), dt.date(2024, 1, 6)), ("places", days[1], days[1])]
    assert rows(scan_table(spark, f"{out}/places")) == places and run() == []
    # Other countries have units of their own.
    assert len(rows(book.pending("stops", "IT", ledger.days_between(spark, *days)))) == 4
    with pytest.raises(ValueError, match="unknown stages"):
        run(stages=("stop",))
