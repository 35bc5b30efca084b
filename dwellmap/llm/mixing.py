"""Temperature mixing of sources.

Weights are the sources' token shares raised to an exponent between 0 (uniform) and 1 (proportional).
The exponent is bisected until the weights meet a target entropy or a limit on repetition. The weights
are then realised as whole passes over each source and part of one more: the first documents of a
pseudo-random permutation that fit the remaining budget, found block by block.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellmap.session import discard, materialise

#: Permutation blocks of a source, as hex digits of the order key: 4096 blocks.
BLOCK_DIGITS = 3
_SECTIONS = 16
_PRECISION = 1e-6


def token_count(text: str = "text"):
    """Tokens as runs of characters that are not ASCII white space; 0 for null."""
    count = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return count.cast("long")


def source_tokens(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Tokens of each source; null is a source too."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.sum(token_count(text)).alias("tokens"))


def _bisect(shares: DataFrame, met: Callable[[float, float, float], bool]) -> float:
    """Smallest exponent of the grid of 1e-6 for which ``met(z, entropy, exponent)`` holds.

    ``met`` must turn from false to true once as the exponent grows. Every job tests several
    exponents at a time over the table of sources, which is never collected.
    """
    low, high = 0.0, 1.0
    while high - low > _PRECISION / 1000:
        grid = [low + (high - low) * i / _SECTIONS for i in range(_SECTIONS + 1)]
        sums = [F.sum(F.pow("p", F.lit(a))).alias(f"z{i}") for i, a in enumerate(grid)]
        logs = [F.sum(F.pow("p", F.lit(a)) * F.log("p")).alias(f"l{i}") for i, a in enumerate(grid)]
        row = shares.agg(*sums, *logs).first()
        z, logs = row[: len(grid)], row[len(grid) :]
        if z[0] is None:
            return 1.0
        fine = [met(z[i], math.log(z[i]) - a * logs[i] / z[i], a) for i, a in enumerate(grid)]
        first = fine.index(True) if True in fine else None
        if first is None:
            return 1.0
        if first == 0:
            return low if low == 0.0 else math.ceil(low / _PRECISION) * _PRECISION
        low, high = grid[first - 1], grid[first]
    return min(1.0, math.ceil(high / _PRECISION) * _PRECISION)


def temperature_weights(
    sources: DataFrame,
    max_repeats: float | None = None,
    entropy: float | None = None,
    budget: float | None = 1.0,
) -> DataFrame:
    """Exponent, weight and token target of each source.

    Give ``max_repeats`` (the flattest weights under which no source is repeated more often) or
    ``entropy`` (in nats; the flattest weights with at most that entropy). ``budget`` is the size of
    the mixture as a multiple of all tokens. With ``budget=None`` the mixture is just large enough to
    hold every source at least once. Sources without tokens get weight 0. A limit that no exponent
    meets gives the exponent 1. The result adds ``exponent``, ``weight`` and ``target_tokens``.
    """
    if (max_repeats is None) == (entropy is None):
        raise ValueError("give either max_repeats or entropy")
    filled = sources.where("tokens > 0")
    row = filled.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    total, least, most = (float(x or 0) for x in row)
    shares = filled.select((F.col("tokens") / F.lit(total or 1.0)).alias("p"))

    def size(z: float, a: float) -> float:
        """Budget as a multiple of all tokens."""
        return budget if budget is not None else z * (most / total) ** (1 - a)

    def met(z: float, h: float, a: float) -> bool:
        if entropy is not None:
            return h <= entropy
        return size(z, a) * (least / total) ** (a - 1) / z <= max_repeats * (1 + 1e-12)

    exponent = round(_bisect(shares, met), 6)
    z = shares.agg(F.sum(F.pow("p", F.lit(exponent)))).first()[0] or 1.0
    wanted = size(z, exponent) * total if total else 0.0
    weight = F.when(
        F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total or 1.0), F.lit(exponent)) / F.lit(z)
    ).otherwise(F.lit(0.0))
    return sources.withColumns({"exponent": F.lit(exponent), "weight": weight}).withColumn(
        "target_tokens", F.floor(F.col("weight") * F.lit(wanted) + F.lit(1e-6)).cast("long")
    )


def mix(
    docs: DataFrame,
    max_repeats: float | None = None,
    entropy: float | None = None,
    budget: float | None = 1.0,
    seed: int = 0,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The documents with ``n_tokens`` and ``copies``, how often each stands in the mixture.

    A source's target is filled with whole passes, then with the first documents, in the order of
    MD5(seed:id), whose running total fits the rest. Where that ends is found by blocks of that order: token
    sums per block of three digits tell the block, sums per block of six digits the part of it, and so on
    until one document is left. So every step sums up at most 4096 blocks a source, a source with a third of
    all rows is never gathered, and documents meet one row per source only; no job moves them. Rows that
    repeat an id are drawn together. A null source is a source, a null text has no tokens, and documents of
    sources without any tokens are drawn once. Columns named ``n_tokens`` or ``copies`` are replaced; other
    names don't matter.
    """
    kept = [c for c in docs.columns if c not in ("n_tokens", "copies")]
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))
    keyed = docs.select(
        F.struct(*kept).alias("doc"),
        F.col(source).alias("source"),
        order.alias("order"),
        token_count(text).alias("tokens"),
    )
    measured = materialise(keyed.select("source", "order", "tokens"))
    blocks = materialise(_blocks(measured, BLOCK_DIGITS))
    sources = materialise(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")))
    plan = temperature_weights(sources, max_repeats, entropy, budget).select(
        F.col("source").alias("s"),
        F.when(F.col("tokens") > 0, F.floor(F.col("target_tokens") / F.col("tokens")))
        .otherwise(F.lit(1))
        .cast("long")
        .alias("passes"),
        F.when(F.col("tokens") > 0, F.col("target_tokens") % F.col("tokens")).alias("rest"),
    )
    plan = materialise(plan)
    cuts = _cuts(measured, blocks, plan.where("rest IS NOT NULL").select("s", "rest"))
    limits = materialise(
        plan.join(cuts.withColumnRenamed("s", "c"), F.col("s").eqNullSafe(F.col("c")), "left").select(
            "s", "passes", "cut"
        )
    )
    discard(measured, blocks, sources, plan)
    extra = F.coalesce((F.col("order") < F.col("cut")).cast("long"), F.lit(0))
    return keyed.join(limits, F.col("source").eqNullSafe(F.col("s"))).select(
        *[F.col("doc")[c].alias(c) for c in kept],
        F.col("tokens").alias("n_tokens"),
        (F.col("passes") + extra).alias("copies"),
    )


def _blocks(measured: DataFrame, digits: int) -> DataFrame:
    """Token sums, and the first and last place, of the documents whose order begins alike."""
    return measured.groupBy("source", F.substring("order", 1, digits).alias("block")).agg(
        F.sum("tokens").alias("tokens"), F.min("order").alias("low"), F.max("order").alias("high")
    )


def _cuts(measured: DataFrame, blocks: DataFrame, rests: DataFrame) -> DataFrame:
    """Per source ``s``, the first order at which the running total of tokens exceeds ``rest``."""
    digits, settled = BLOCK_DIGITS, []
    before = Window.partitionBy("s").orderBy("block")
    while True:
        summed = blocks.join(rests, F.col("source").eqNullSafe(F.col("s"))).withColumn(
            "upto", F.sum("tokens").over(before)
        )
        at = F.min(F.struct("block", "low", "high", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("rest")))
        first = materialise(summed.where("upto > rest").groupBy("s").agg(at.alias("at")).select("s", "at.*"))
        settled.append(first.where("low = high").select("s", F.col("low").alias("cut")))
        wider = first.where("low <> high")
        if wider.isEmpty():
            break
        inside = F.col("source").eqNullSafe(F.col("s")) & (F.substring("order", 1, digits) == F.col("block"))
        measured = materialise(measured.join(wider, inside).select("source", "order", "tokens"))
        digits += BLOCK_DIGITS
        blocks, rests = _blocks(measured, digits), wider.select("s", "rest")
    found = settled[0]
    for part in settled[1:]:
        found = found.unionByName(part)
    return found
