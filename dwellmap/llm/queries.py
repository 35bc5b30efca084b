"""One query per operator, over whole tables, and the DuckDB equivalents where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmap.llm import exact_dedup, html_blocks, langid, line_dedup, mixing, ordinal_quality
from dwellmap.llm import packing, parity_join, pivot_dedup, runs, spelling, suffix_dedup, token_files
from dwellmap.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> tuple[str, tuple[str, str]]:
    """The installed public tokenizer, and its vocabulary as ranks with the split pattern. Every
    executor has the same installation."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return public_tokenizers.path("byte_bpe_50k.json"), (ranks, public_tokenizers.PATTERN)


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_dedup.near_vectors(_table(spark, sf_dir, "embeddings"), least=0.9)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_blocks.extract(pages, html_blocks.train(pages)).drop("html")


def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=400)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ratings = ordinal_quality.graded(_table(spark, sf_dir, "labels"))
    model = ordinal_quality.train(docs, ratings)
    return ordinal_quality.grade(docs.select("doc_id", "text"), model).drop("text")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as the table has, no source more than twice."""
    out = mixing.mix(_table(spark, sf_dir, "documents"), max_repeats=2.0, budget=1.0)
    return out.select("doc_id", "source", "n_tokens", "copies")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_spread_lines(_table(spark, sf_dir, "documents"), max_share=None)
    return out.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.near_groups(_table(spark, sf_dir, "documents"), percent=90, words=3)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ranks = tokenizer()
    return packing.pack(_table(spark, sf_dir, "documents"), path, ranks=ranks)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_table(spark, sf_dir, "documents"), rewrite=runs.continued)
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = token_files.write_token_files(
        _table(spark, sf_dir, "documents"),
        scratch_path(spark, "tokens"),
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
    )
    return files.documents().withColumnRenamed("id", "doc_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(_table(spark, sf_dir, "documents"), rewrite=spelling.misspelt)
    return spelling.variant_groups(counts)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_vectors": op1_near_vectors,
    "op2_html_text": op2_html_text,
    "op3_repeated_strings": op3_repeated_strings,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality": op5_quality,
    "op6_source_mixing": op6_source_mixing,
    "op7_language_id": op7_language_id,
    "op8_line_dedup": op8_line_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_files": op12_token_files,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       coalesce(doc_id = max(doc_id) OVER same, false) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op6_source_mixing": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents),
s AS (SELECT source, sum(n_tokens) AS t FROM d GROUP BY source),
a AS (SELECT CAST(sum(t) AS DOUBLE) AS total, CAST(min(t) AS DOUBLE) AS least FROM s WHERE t > 0),
b(step, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT step + 1, CASE WHEN fine THEN lo ELSE (lo + hi) / 2 END, CASE WHEN fine THEN (lo + hi) / 2 ELSE hi END
  FROM (SELECT b.*, (SELECT pow(any_value(a.least / a.total), (lo + hi) / 2 - 1)
                            / sum(pow(s.t / a.total, (lo + hi) / 2)) FROM s, a WHERE s.t > 0)
                    <= 2 * (1 + 1e-12) AS fine FROM b WHERE step < 40)),
e AS (SELECT round(least(1, ceil(hi * 1e6) / 1e6), 6) AS x FROM b WHERE step = 40),
flat AS (SELECT CASE WHEN count(*) * any_value(a.least / a.total) * 2 * (1 + 1e-12) >= 1 THEN 0
                     ELSE any_value(e.x) END AS x
         FROM s, a, e WHERE s.t > 0),
z AS (SELECT sum(pow(s.t / a.total, flat.x)) AS z FROM s, a, flat WHERE s.t > 0),
w AS (SELECT source, t, CAST(floor(pow(t / a.total, flat.x) / z.z * a.total + 1e-6) AS BIGINT) AS target
      FROM s, a, flat, z),
c AS (SELECT d.*, w.t, w.target,
             sum(n_tokens) OVER (PARTITION BY d.source ORDER BY d.o) AS upto
      FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, source, n_tokens,
       CASE WHEN t = 0 THEN 1
            ELSE CAST(target // t + CAST(upto <= target % t AS BIGINT) AS BIGINT) END AS copies
FROM c
""",
    "op8_line_dedup": r"""
WITH l AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         string_split(coalesce(text, ''), chr(10)) AS parts
  FROM documents),
x AS (
  SELECT r, source, i, parts[i] AS line, trim(parts[i], ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS t
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM l)),
spread AS (SELECT t FROM x WHERE length(t) >= 12 GROUP BY t HAVING count(DISTINCT source) >= 10),
m AS (SELECT x.*, t IN (SELECT t FROM spread) AS hit FROM x),
g AS (
  SELECT r, any_value(source) AS source, count(*) FILTER (WHERE length(t) > 0) AS n_lines,
         count(*) FILTER (WHERE hit) AS n_hit,
         string_agg(t, chr(10) ORDER BY i) FILTER (WHERE length(t) > 0) AS whole,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT hit), '') AS left_text
  FROM m GROUP BY r),
copied AS (SELECT whole FROM g WHERE n_lines > 1 GROUP BY whole HAVING count(DISTINCT source) >= 10),
d AS (SELECT g.*, n_hit > 0 AND NOT (n_lines > 1 AND whole IN (SELECT whole FROM copied)) AS cut FROM g)
SELECT l.doc_id, d.n_lines, CASE WHEN cut THEN n_hit ELSE 0 END AS n_removed,
       sha256(CASE WHEN cut THEN left_text ELSE l.text END) AS text_sha256
FROM l JOIN d USING (r)
""",
}
