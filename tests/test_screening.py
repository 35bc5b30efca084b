"""Files that cannot be read are told from those that can."""

import gzip

from pyspark.sql import functions as F

from dwellmap.sources import screening, sinks


def test_every_kind_of_bad_file(spark, tmp_path):
    text = b"".join(b"%d\tx\n" % i for i in range(50_000))
    packed = gzip.compress(text)
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    table = next((tmp_path / "t").glob("part-*.parquet")).read_bytes()
    files = {
        "a.gz": (packed, "sound"),
        "two.gz": (packed + gzip.compress(b"more"), "sound"),
        "runs.gz": (gzip.compress(b"\0" * 30_000_000), "sound"),
        "cut.gz": (packed[: len(packed) // 2], "cut"),
        "cutmore.gz": (packed[:-3], "cut"),
        "spoilt.gz": (packed[:5000] + b"\xff" * 40 + packed[5040:], "cut"),
        "empty.gz": (b"", "empty"),
        "plain.gz": (text, "foreign"),
        "b.parquet": (table, "sound"),
        "cut.parquet": (table[:-20], "cut"),
        "short.parquet": (b"PAR1", "cut"),
        "no.parquet": (text, "foreign"),
        "empty.parquet": (b"", "empty"),
        "x.csv": (text, "sound"),
        "y.csv": (b"", "empty"),
    }
    (tmp_path / "in" / "deeper").mkdir(parents=True)
    for name, (data, _) in files.items():
        (tmp_path / "in" / "deeper" / name).write_bytes(data)
    got = screening.screen_files(spark, str(tmp_path / "in"))
    assert {r.path.rpartition("/")[2]: r.verdict for r in got.collect()} == {n: v for n, (_, v) in files.items()}
    assert {r.length for r in got.where("verdict = 'empty'").collect()} == {0}
    good = screening.sound_paths(screening.screen_files(spark, str(tmp_path / "in"), "*.parquet"))
    assert spark.read.parquet(*good).count() == 1000


def test_partitions_are_told_by_file_names(spark, tmp_path):
    rows = spark.range(40).select("id", (F.col("id") % 4).alias("a"), (F.col("id") % 2).alias("b"))
    sinks.write_table(rows, str(tmp_path / "t"), ("a", "b"))
    (tmp_path / "t" / "a=9" / "b=9").mkdir(parents=True)
    (tmp_path / "t" / "a=9" / "b=9" / "part-0.parquet").write_bytes(b"")
    found = sinks.written_partitions(spark, str(tmp_path / "t"), ("a", "b"))
    assert sorted(map(tuple, found.collect())) == [("0", "0"), ("1", "1"), ("2", "0"), ("3", "1")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower() and "content" not in plan


def test_spoiling_reads_no_file_into_the_driver(spark, tmp_path):
    from dwellmap.checks.fixtures import spoil

    folder, limit = str(tmp_path / "raw"), "spark.sql.sources.binaryFile.maxLength"
    spark.range(5000).selectExpr("id", "id % 2 AS d").write.partitionBy("d").option("compression", "gzip").csv(folder)
    longest = max((tmp_path / "raw").rglob("part-*.gz"), key=lambda f: (f.stat().st_size, [-ord(c) for c in str(f)]))
    spark.conf.set(limit, "10")
    try:
        spoil(spark, folder)
    finally:
        spark.conf.unset(limit)
    whole = longest.read_bytes()
    assert (longest.parent / "part-cut.csv.gz").read_bytes() == whole[: len(whole) // 2]
    assert (longest.parent / "part-empty.csv.gz").read_bytes() == b""
    assert (longest.parent / "part-foreign.csv.gz").read_bytes() == b"1\t2\n" * 9
