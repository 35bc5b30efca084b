"""Removal of boilerplate lines, which stand on many distinct sites.

Every line hash gets a HyperLogLog sketch of the sites it was seen on; sketches merge by aggregation.
Estimates far from the threshold decide at once. Lines whose estimate lies near it get an exact count
of distinct sites.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmap.session import discard, materialise

def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\f\v"))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _key(line: Column) -> Column:
    return F.unhex(F.md5(_trimmed(line)))


def _keyed(docs: DataFrame, id_column: str | None, min_chars: int, text: str, site: str, whole: bool) -> DataFrame:
    """What is asked of the texts, read once: ``id``, ``site``, ``keys`` of the distinct lines of at least
    ``min_chars``, and, with ``whole``, the key of the text's trimmed lines, null if fewer than two of them are
    filled. Keys are MD5 sums of trimmed lines."""
    columns = [F.col(site).cast("string").alias("site"), F.transform(_lines(text), _trimmed).alias("lines")]
    if id_column:
        columns.append(F.col(id_column).alias("id"))
    trimmed = docs.select(columns)
    # Distinct as strings: binary values are compared all with all.
    long = F.array_distinct(F.filter("lines", lambda x: F.length(x) >= min_chars))
    keys = F.transform(long, lambda x: F.unhex(F.md5(x))).alias("keys")
    if whole:
        filled = trimmed.withColumn("filled", F.filter("lines", lambda x: F.length(x) > 0))
        several = F.when(F.size("filled") > 1, F.unhex(F.md5(F.array_join("filled", "\n"))))
        return materialise(filled.select("id", "site", keys, several.alias("whole")))
    return materialise(trimmed.select(*trimmed.drop("lines").columns, keys))


def _whole(text: str) -> Column:
    """MD5 of a text's trimmed lines, null if fewer than two of them are filled."""
    lines = F.filter(F.transform(_lines(text), _trimmed), lambda x: F.length(x) > 0)
    return F.when(F.size(lines) > 1, F.unhex(F.md5(F.array_join(lines, "\n"))))


def copied_texts(docs: DataFrame, min_sites: int = 10, text: str = "text", site: str = "source") -> DataFrame:
    """Keys of the texts of several lines that stand as a whole on at least ``min_sites`` distinct sites."""
    return _on_sites(docs.select(_whole(text).alias("key"), F.col(site).cast("string").alias("site")), min_sites)


def _on_sites(keyed: DataFrame, min_sites: int) -> DataFrame:
    """Keys that stand on at least ``min_sites`` distinct sites."""
    return materialise(
        keyed.where("key IS NOT NULL AND site IS NOT NULL")
        .groupBy("key", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_sites)
        .select("key")
    )


def spread_lines(
    docs: DataFrame,
    min_sites: int = 10,
    min_chars: int = 12,
    text: str = "text",
    site: str = "source",
    lg_k: int = 12,
    band: float = 0.1,
) -> DataFrame:
    """Keys (MD5 of the trimmed line) of the lines found on at least ``min_sites`` distinct sites.

    Lines shorter than ``min_chars`` after trimming don't count. A null site is no site. ``lg_k``
    sets the sketch size (4096 registers: a standard error of 1.6 %); estimates within ``band`` of
    the threshold are counted exactly, which is six standard errors.
    """
    return _spread(_keyed(docs, None, min_chars, text, site, False), min_sites, lg_k, band)


def _spread(keyed: DataFrame, min_sites: int, lg_k: int = 12, band: float = 0.1) -> DataFrame:
    lines = keyed.select("site", F.explode("keys").alias("key"))
    low, high = math.floor(min_sites * (1 - band)), math.ceil(min_sites * (1 + band))
    estimates = materialise(
        lines.groupBy("key")
        .agg(F.hll_sketch_agg("site", lg_k).alias("sketch"))
        .select("key", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= low)
    )
    near = estimates.where(F.col("sites") <= high).select("key")
    exact = (
        lines.join(near, "key", "left_semi")
        .groupBy("key", "site")
        .agg(F.lit(1).alias("one"))
        .where("site IS NOT NULL")
        .groupBy("key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_sites)
        .select("key")
    )
    return materialise(estimates.where(F.col("sites") > high).select("key").union(exact))


def remove_spread_lines(
    docs: DataFrame,
    min_sites: int = 10,
    min_chars: int = 12,
    max_share: float | None = 0.5,
    id_column: str = "doc_id",
    text: str = "text",
    site: str = "source",
) -> DataFrame:
    """The documents without the lines that stand on ``min_sites`` or more distinct sites.

    Adds ``n_lines`` (non-blank lines before) and ``n_removed``. A document in which such lines hold
    more than ``max_share`` of the characters is itself a widely copied text and is left as it is:
    choosing among copies is the business of document deduplication. With ``max_share=None`` the share
    doesn't matter: only a text of several lines that stands as a whole on ``min_sites`` or more sites
    is a copied one, and all others lose such lines, if need be all they have. Null text stays null; rows that
    repeat an id are handled alike, and a null id is an id of its own. ``n_chars``, if there, is
    brought up to date. All other columns stay as they are.

    Texts are read twice: for the keys of their lines, which are written with the ids, and to take lines out.
    Only keys are shuffled to find a document's boilerplate, one set per document, so nothing grows
    with the number of documents that share a line.
    """
    keyed = _keyed(docs, id_column, min_chars, text, site, max_share is None)
    spread = _spread(keyed, min_sites)
    found = keyed.select(F.col("id").alias("__id"), F.explode("keys").alias("key")).join(spread, "key")
    sets = [F.collect_set("key").alias("__drop")]
    if max_share is None:
        # Per id as well, as rows that share an id, such as null, need not share their text.
        wholes = keyed.select("id", "site", F.col("whole").alias("key"))
        copies = wholes.join(_on_sites(wholes, min_sites), "key").select(F.col("id").alias("__id"), F.col("key").alias("whole"))
        found = found.unionByName(copies, allowMissingColumns=True)
        sets.append(F.collect_set("whole").alias("__copied"))
    found = materialise(found.groupBy("__id").agg(*sets))
    discard(keyed)
    # The same plan at every size: texts are dealt by id whether or not few documents are affected.
    joined = docs.join(found.hint("merge"), docs[id_column].eqNullSafe(found["__id"]), "left")

    def spread_line(x: Column) -> Column:
        return F.array_contains(F.col("__drop"), _key(x))

    def chars(lines: Column) -> Column:
        return F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(_trimmed(x)))

    lines = _lines(text)
    worked = joined.withColumn(
        "__kept",
        F.when(F.col("__drop").isNotNull(), F.filter(lines, lambda x: ~spread_line(x))),
    )
    if max_share is None:
        removable = ~F.coalesce(F.array_contains("__copied", _whole(text)), F.lit(False))
    else:
        removable = chars(F.col("__kept")) >= (1 - max_share) * chars(lines)
    worked = worked.withColumn("__kept", F.when(removable, F.col("__kept")))

    def filled(of: Column) -> Column:
        return F.size(F.filter(of, lambda x: F.length(_trimmed(x)) > 0)).cast("long")

    out = worked.withColumns(
        {
            "__n_lines": filled(lines),
            "__n_removed": F.when(
                F.col("__kept").isNotNull(), (F.size(lines) - F.size("__kept")).cast("long")
            ).otherwise(F.lit(0).cast("long")),
            "__text": F.when(
                F.col("__kept").isNotNull(), F.array_join("__kept", "\n")
            ).otherwise(F.col(text)),
        }
    )
    columns = []
    for name in docs.columns:
        if name == text:
            columns.append(F.col("__text").alias(text))
        elif name == "n_chars" and name in docs.columns:
            kind = docs.schema["n_chars"].dataType
            changed = F.length("__text").cast(kind)
            columns.append(F.when(F.col("__n_removed") > 0, changed).otherwise(docs["n_chars"]).alias(name))
        elif name not in ("n_lines", "n_removed"):
            columns.append(docs[name])
    return out.select(
        *columns, F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed")
    )
