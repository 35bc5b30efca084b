"""From raw documents to packed training sequences, in five stages.

Every stage reads all that its predecessor kept, as a Parquet table in the shared folder, and all but
the last return the columns of ``documents``. The table between two stages survives lost executors and
is deleted when the next one stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmap.llm import langid, line_dedup, mixing, packing, parity_join
from dwellmap.llm.queries import tokenizer
from dwellmap.session import discard, materialise

#: Lead of the likeliest language over the second, below which a document goes. Lower than what the operator
#: flags: on check_s, 3 of 51282 documents lie below and 6 more, mostly clean texts, below the operator's 0.1.
MIN_LEAD = 0.02
#: Larger sources appear once, smaller ones up to so many times.
MAX_REPEATS = 1.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told: those without a letter, or for which two languages are
    about as likely, go."""
    model = langid.train(docs.where(~langid.held_out()))
    if not model.languages:
        return docs
    # Under a name of its own, so that columns of the documents are never replaced.
    judged = langid.identify(
        docs.select(F.struct(*docs.columns).alias("doc")), model, text="doc.text", min_lead=MIN_LEAD
    )
    return judged.where(~F.col("ambiguous")).select("doc.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on ten or more sites; no document goes, and texts copied as
    a whole to ten or more sites are left to ``near_duplicates``."""
    return line_dedup.remove_spread_lines(docs, max_share=None).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies: 80 % of the five-word
    shingles in common, transitively. Repeated rows of one document become one; rows with a null id
    are kept."""
    groups = parity_join.near_groups(docs, percent=80, words=5)
    stays = groups.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(stays.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, documents of smaller sources up to MAX_REPEATS times."""
    mixed = mixing.mix(docs, max_repeats=MAX_REPEATS, budget=None)
    return mixed.select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))).alias("__copy")
    ).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 1024 tokens."""
    path, ranks = tokenizer()
    return packing.pack(docs, path, ranks=ranks)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: A trained classifier and a tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        done = materialise(stage(spark, docs, sf_dir))
        discard(docs)
        docs = done
    return docs
