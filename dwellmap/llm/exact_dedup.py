"""Exact deduplication against a persistent index of text digests.

The index is a Parquet table of (digest, keep_id), bucketed and sorted by digest. A batch of documents
is reduced to one row per digest, sort-merge anti-joined with the index without shuffling the index,
and the rows that survive are appended. The index outlives the session: ``DigestIndex.open`` finds it
again by its path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmap.session import materialise, scratch_path

SCHEMA = "digest binary, keep_id long"


#: Hidden from scans of the index.
_LAYOUT = "_layout"


def text_digest(text: str = "text"):
    """SHA-256 of the UTF-8 text as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


class DigestIndex:
    """Digests seen so far and the document kept for each."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        # The catalog may forget the table with the session; the files and their layout stay.
        self.table = f"digest_index_{uuid.uuid4().hex}"

    @classmethod
    def create(cls, spark: SparkSession, path: str, buckets: int = 64) -> DigestIndex:
        """An empty index. Choose the buckets for the size it will grow to: they can't be changed."""
        index = cls(spark, path, buckets)
        index._write(spark.createDataFrame([], SCHEMA), "errorifexists")
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path}/{_LAYOUT}")
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int | None = None) -> DigestIndex:
        """An index made earlier, perhaps by another session. The number of buckets stands beside it; a
        different one, if given, is refused, as it would keep texts twice."""
        stored = spark.read.parquet(f"{path}/{_LAYOUT}").first()["buckets"]
        if buckets not in (None, stored):
            raise ValueError(f"the index has {stored} buckets, not {buckets}")
        buckets = stored
        index = cls(spark, path, buckets)
        spark.sql(
            f"CREATE TABLE {index.table} ({SCHEMA}) USING parquet CLUSTERED BY (digest) "
            f"SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return index

    def _write(self, rows: DataFrame, mode: str) -> None:
        (
            rows.write.mode(mode)
            .format("parquet")
            .option("path", self.path)
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.table)
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
        """Add a batch and say for each of its rows which document stays.

        Returns one row per input row: the id, ``keep_id``, ``group_size`` (rows of this batch with
        this text), ``kept`` and ``digest``. Of equal texts in a batch the largest id stays, unless
        an earlier batch had the text with an id already: then that batch's document does. Texts are equal when
        identical; null and empty are equal. Rows with a null id are never kept while another row has
        the text; repeated rows of one document share its answer.

        A batch is reduced on the map side before its shuffle, so a text with very many copies is one
        row per task there. The join that hands the answer to every copy has a shuffle on both sides,
        where adaptive execution splits a skewed partition.
        """
        hashed = docs.select(F.col(id_column).alias("id"), text_digest(text).alias("digest"))
        groups = materialise(
            hashed.groupBy("digest").agg(F.max("id").alias("batch_id"), F.count("*").alias("n"))
        )
        # Cut off from the table it is appended to.
        fresh = materialise(
            groups.join(self.read().hint("merge"), "digest", "left_anti").select(
                "digest", F.col("batch_id").alias("keep_id")
            )
        )
        # A text that only rows without an id have gets no owner yet; a later batch may bring one.
        owned = fresh.where("keep_id IS NOT NULL")
        self._write(owned.repartition(self.buckets, "digest"), "append")
        answers = materialise(groups.join(self.read().hint("merge"), "digest", "left"))
        return hashed.join(answers, "digest").select(
            F.col("id").alias(id_column),
            "keep_id",
            F.col("n").alias("group_size"),
            F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"),
            "digest",
        )


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``DigestIndex.add`` on a new index in the shared folder, for a single batch."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = DigestIndex.create(spark, scratch_path(spark, "digests"), buckets)
    return index.add(docs, id_column, text)
