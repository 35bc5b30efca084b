"""Comparing the members of long lists in bounded tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deal_blocks(members: DataFrame, block: int, load: DataFrame | None = None) -> DataFrame:
    """Give the members (key, id, ...) of every list to comparisons of two blocks.

    A list is cut into blocks of about ``block`` members by a hash; every pair of blocks, and every
    block with itself, is one comparison (key, i, j) with i <= j. ``side`` is 0 for the members of
    block i and 1 for those of block j. A list of usual length is one comparison. The rows of a
    comparison come together, sorted, in one partition. ``load`` holds wide columns by ``id``; they
    join once everything else is settled, so that they move once only.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int")
    dealt = (
        members.join(sizes, "key")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns(
            {
                "i": F.least("own", "other"),
                "j": F.greatest("own", "other"),
                "side": (F.col("own") > F.col("other")).cast("int"),
            }
        )
        .drop("blocks", "own", "other")
    )
    if load is not None:
        dealt = dealt.join(load, "id")
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "id")


def whole_comparisons(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole comparisons, one after another, and where each begins (and the last ends)."""
    held: list[pa.RecordBatch] = []

    def starts(table: pa.Table) -> np.ndarray:
        changes = np.zeros(max(len(table) - 1, 0), bool)
        for name in ("key", "i", "j"):
            column = table[name].to_numpy()
            changes |= column[1:] != column[:-1]
        return np.concatenate([[0], np.flatnonzero(changes) + 1, [len(table)]])

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        bounds = starts(table)
        if len(bounds) > 2:
            yield table.slice(0, bounds[-2]), bounds[:-1]
            held = table.slice(bounds[-2]).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, starts(table)


def comparisons(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, pa.Table | None]]:
    """The two blocks of each comparison, as tables; None for the second if a block meets itself."""
    held: list[pa.RecordBatch] = []
    last = None

    def split(parts: list[pa.RecordBatch]) -> tuple[pa.Table, pa.Table | None]:
        table = pa.Table.from_batches(parts).combine_chunks()
        if table["i"][0].as_py() == table["j"][0].as_py():
            return table, None
        first = table["side"].to_pylist().count(0)
        return table.slice(0, first), table.slice(first)

    for batch in batches:
        names = list(zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j")), strict=True))
        start = 0
        for row in range(len(names) + 1):
            if row == len(names):
                if row > start:
                    held.append(batch.slice(start, row - start))
                    last = names[-1]
            elif last is not None and names[row] != last:
                if row > start:
                    held.append(batch.slice(start, row - start))
                if held:
                    yield split(held)
                held, start, last = [], row, names[row]
            elif last is None:
                last = names[row]
    if held:
        yield split(held)
