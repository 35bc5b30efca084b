"""Removal of long byte strings that occur more than once, by merging shard suffix orders.

Equal strings of the wanted length contain an equal anchor: the gram with the least hash among all
grams inside. Anchors that occur once need no look. The text around each other anchor is a context;
contexts are gathered by anchor, equal ones once, and cut into shards. Every shard sorts its own suffixes
(the order of its Burrows-Wheeler transform). The orders are merged by refining their interleave: in every
round, rows that agree in the depth compared so far are told apart by the class of the row that follows at
that depth, so the depth doubles. A round sorts the keys of all rows of a batch; strings are not compared
again. Rows that still agree at the wanted length are repeated strings. The transforms themselves are not
read by the merge and no common prefixes are derived; the README says why.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmap.llm.texthash import _byte_values, _power, chunks, mix
from dwellmap.session import discard, materialise

#: Distinct contexts of one anchor that a task merges. Beyond, windows are compared by digests.
MAX_CONTEXTS = 2048
_SHARD_BYTES = 1 << 18
_BATCH_BYTES = 1 << 19
_PACKED = 7
_PRIME = np.uint64(0xD6E8FEB86659FD93)


def gram_size(length: int) -> int:
    return max(1, length * 8 // 25)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` consecutive ones."""
    n = len(values)
    if width == 1:
        return values
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    tiles = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(tiles, axis=1).ravel()
    back = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(grams: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text, given the hashes of its grams: hash, first and last start, repeated.

    A start is where a string of the wanted length begins; its anchor is the gram with the least hash
    inside, the leftmost of equal ones. Neighbouring starts mostly share it. Runs of starts whose
    anchors have the same hash, as in periodic text, become one; only there a string can occur twice
    around one anchor, which ``repeated`` tells.
    """
    width = length - gram_size(length) + 1
    if len(grams) < width:
        nothing = np.zeros(0, np.int64)
        return nothing.astype(np.uint64), nothing, nothing, nothing.astype(bool)
    low = np.uint64(0xFFFFFFFF)
    place = (_sliding_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width) & low).astype(np.int64)
    hashes = grams[place]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    last = np.concatenate((first[1:], [len(place)])) - 1
    return hashes[first], first, last, place[first] != place[last]


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    n = len(data)
    if n < size:
        return np.zeros(0, np.uint64)
    # Every byte value counts: unlike words, strings are compared as they are.
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_plain_values()[data] * _power("up", n), out=total[1:])
    return mix((total[size:] - total[:-size]) * _power("down", n)[: n - size + 1])


def _plain_values() -> np.ndarray:
    values = _byte_values().copy()
    values[65:91] = mix(np.arange(2001, 2027, dtype=np.uint64))
    return values


def _find_anchors(length: int):
    size = gram_size(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in chunks(batch.column(2)):
                with np.errstate(over="ignore"):
                    grams = _gram_hashes(data, size)
                owner, parts = [], []
                for row in range(last - first):
                    lo, hi = bounds[row], bounds[row + 1]
                    if hi - lo >= length:
                        part = anchors(grams[lo : hi - size + 1], length)
                        owner.append(np.full(len(part[0]), first + row))
                        parts.append(part)
                if not parts:
                    continue
                hashes, starts, ends, repeated = (np.concatenate(c) for c in zip(*parts, strict=True))
                rows = pa.array(np.concatenate(owner))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(hashes.view(np.int64)),
                        pa.array(starts),
                        pa.array(ends),
                        pa.array(repeated),
                    ],
                    ["id", "digest", "anchor", "first", "last", "repeated"],
                )

    return run


def _cut_contexts(length: int):
    """Contexts of a text's anchors: the bytes from the first start to the end of the last string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for digest, text, spots in zip(*batch.columns, strict=True):
                digest, raw = digest.as_py(), text.as_py().encode()
                for spot in spots.as_py():
                    context = raw[spot["first"] : spot["last"] + length]
                    name = hashlib.md5(context).digest()
                    rows.append((digest, spot["anchor"], spot["first"], name, context))
                    held += len(context)
                    if held > _BATCH_BYTES:
                        yield _context_batch(rows)
                        rows, held = [], 0
            if rows:
                yield _context_batch(rows)

    return run


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    digest, anchor, first, name, context = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(digest, pa.binary()),
            pa.array(anchor, pa.int64()),
            pa.array(first, pa.int64()),
            pa.array(name, pa.binary()),
            pa.array(context, pa.binary()),
        ],
        ["digest", "anchor", "first", "name", "context"],
    )


class Shard:
    """Burrows-Wheeler order of some contexts, as deep as ``length`` symbols.

    ``order`` holds the text position of each row, ``end`` the row of every position's terminator.
    A context is followed by a terminator smaller than any byte, and no comparison crosses it.
    """

    def __init__(self, contexts: list[bytes], length: int):
        sizes = np.array([len(c) for c in contexts], np.int64)
        raw = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
        ends = np.cumsum(sizes + 1) - 1
        symbols = raw.astype(np.int64) + 1
        symbols[ends] = 0
        n = len(symbols)
        at = np.arange(n, dtype=np.int64)
        self.end = np.repeat(ends, sizes + 1)
        self.heads = ends - sizes
        packed = symbols.copy()
        for i in range(1, _PACKED):
            packed = packed * 257 + symbols[np.minimum(at + i, self.end)]
        self.packed = packed
        order = np.argsort(packed, kind="stable")
        rank, depth = self._ranks(packed[order], order), _PACKED
        while depth < length and rank[order[-1]] + 1 < n:
            key = rank * n + rank[np.minimum(at + depth, self.end)]
            order = np.argsort(key, kind="stable")
            rank, depth = self._ranks(key[order], order), 2 * depth
        self.order = order
        row = np.empty(n, np.int64)
        row[order] = at
        self.row = row
        # The Burrows-Wheeler transform: the symbol before each row's suffix.
        self.transform = symbols[order - 1]

    @staticmethod
    def _ranks(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1])))
        return rank

    def jump(self, steps: int) -> np.ndarray:
        """For each row, the row of the suffix that starts so many symbols later."""
        return self.row[np.minimum(self.order + steps, self.end[self.order])]


def merge(shards: list[Shard], length: int) -> np.ndarray:
    """For each row of the shards, one after another, the class of its first ``length`` symbols.

    Classes are numbered in the merged order. A round doubles the depth h: the new key of a row is its
    class and the class of the row h symbols on. Keys rise along every shard, since its rows are in
    order, so interleaving them again is a merge of sorted runs; the interleave of the round before is
    refined, never undone.
    """
    if not shards:
        return np.zeros(0, np.int64)
    keys = np.concatenate([s.packed[s.order] for s in shards])
    bases = np.cumsum([0, *(len(s.order) for s in shards)])
    depth = _PACKED

    def classes(keys: np.ndarray) -> np.ndarray:
        interleave = np.argsort(keys, kind="stable")
        merged = keys[interleave]
        found = np.empty(len(keys), np.int64)
        found[interleave] = np.concatenate(([0], np.cumsum(merged[1:] != merged[:-1])))
        return found

    known = classes(keys)
    while depth < length:
        step = min(depth, length - depth)
        later = np.concatenate([s.jump(step) + b for s, b in zip(shards, bases, strict=False)])
        known = classes(known * len(keys) + known[later])
        depth += step
    return known


def repeated_starts(
    contexts: list[bytes], counts: list[int], length: int
) -> list[list[tuple[int, int]]]:
    """For each distinct context, the runs (first, last) of starts whose strings occur elsewhere too.

    ``counts`` tells how often each context occurs; in one that occurs twice, all do.
    """
    shards: list[Shard] = []
    some: list[bytes] = []
    for context in contexts:
        some.append(context)
        if sum(map(len, some)) >= _SHARD_BYTES if len(some) % 64 == 0 else False:
            shards.append(Shard(some, length))
            some = []
    if some:
        shards.append(Shard(some, length))
    known = merge(shards, length)
    out: list[list[tuple[int, int]]] = []
    number, base = 0, 0
    starts_of = []
    # Classes of the starts only: positions with a whole string ahead.
    for shard in shards:
        by_position = np.empty(len(shard.order), np.int64)
        by_position[shard.order] = known[base : base + len(shard.order)]
        for head in shard.heads:
            size = len(contexts[number])
            starts_of.append(by_position[head : head + size - length + 1])
            number += 1
        base += len(shard.order)
    sizes = np.bincount(np.concatenate(starts_of), minlength=1) if starts_of else np.zeros(1, int)
    for starts, count in zip(starts_of, counts, strict=True):
        again = np.ones(len(starts), bool) if count > 1 else sizes[starts] > 1
        edges = np.flatnonzero(np.diff(np.concatenate(([0], again.astype(np.int8), [0]))))
        out.append([(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)])
    return out


_RUNS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _merge_contexts(length: int):
    """Merge the contexts of a partition, sorted by anchor, a few whole anchors at a time."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        anchor, name, context, count = zip(*rows, strict=True)
        runs = repeated_starts(list(context), list(count), length)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(anchor, pa.int64()),
                pa.array(name, pa.binary()),
                pa.array([[{"a": a, "b": b} for a, b in r] for r in runs], _RUNS),
            ],
            ["anchor", "name", "runs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held > _BATCH_BYTES and row[0] != rows[-1][0]:
                    yield settle(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[2])
        if rows:
            yield settle(rows)

    return run


def _windows(length: int):
    """Digests of all strings of the wanted length in each context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                data = np.frombuffer(batch.column(2)[row].as_py(), np.uint8)
                with np.errstate(over="ignore"):
                    one = _gram_hashes(data, length)
                    two = _gram_hashes(((data.astype(np.uint16) * 167 + 13) % 256).astype(np.uint8), length)
                    two = mix(two * _PRIME)
                n = len(one)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        batch.column(0).take(pa.array(np.full(n, row))),
                        batch.column(1).take(pa.array(np.full(n, row))),
                        pa.array(np.arange(n)),
                        batch.column(3).take(pa.array(np.full(n, row))),
                    ],
                    ["one", "two", "anchor", "name", "start", "count"],
                )

    return run


def _covered(length: int):
    """Bytes, spans and digest of what stays, from a text and the runs of repeated starts."""

    @F.arrow_udf("struct<removed long, spans long, kept string>")
    def covered(texts: pa.Array, runs: pa.Array) -> pa.Array:
        removed, spans, kept = [], [], []
        for text, found in zip(texts, runs, strict=True):
            raw = text.as_py().encode()
            merged: list[list[int]] = []
            for a, b in sorted((r["a"], r["b"]) for r in found.as_py()):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b + length)
                else:
                    merged.append([a, b + length])
            digest, at = hashlib.sha256(), 0
            for a, b in merged:
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at:])
            removed.append(sum(b - a for a, b in merged))
            spans.append(len(merged))
            kept.append(digest.hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string())],
            ["removed", "spans", "kept"],
        )

    return covered


def remove_repeats(
    docs: DataFrame,
    length: int = 400,
    id_column: str = "doc_id",
    text: str = "text",
    max_contexts: int = MAX_CONTEXTS,
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    Texts are UTF-8 bytes, null is empty. A byte is removed if a string of ``length`` bytes that
    covers it starts anywhere else too, in the same document or another; strings don't cross documents
    and are judged on the input. Spans are the maximal removed runs.

    Equal texts are looked at once: those with a copy go whole, if long enough, and still count as
    others. Anchors are counted by aggregation, and texts move once, only those with an anchor that
    occurs again. Contexts are pre-aggregated, so a passage in a third of all documents is one context
    away from its edges. An anchor with more than ``max_contexts`` distinct contexts, such as one near
    the edge of that passage, is not given to one task: its strings are compared by 128-bit digests,
    by aggregation, with the same result.
    """
    source = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("digest", F.unhex(F.md5("text")))
    # A null id must still find its way to its text.
    source = source.withColumn("key", F.coalesce(F.col("id").cast("string"), F.lit("")))
    classes = materialise(
        source.where(F.octet_length("text") >= length)
        .groupBy("digest")
        .agg(F.count("*").alias("copies"), F.min("key").alias("key"))
    )
    found = materialise(
        source.select("key", "digest", "text").mapInArrow(
            _find_anchors(length),
            "key string, digest binary, anchor long, first long, last long, repeated boolean",
        )
    )
    spots = found.join(classes.select("key", "digest"), ["key", "digest"], "left_semi").dropDuplicates(
        ["digest", "first"]
    )
    live = (
        spots.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.max("repeated").alias("again"))
        .where("n > 1 OR again")
        .select("anchor")
    )
    wanted = (
        spots.join(live, "anchor")
        .groupBy("key", "digest")
        .agg(F.collect_list(F.struct("anchor", "first", "last")).alias("spots"))
    )
    texts = materialise(
        source.select("key", "digest", "text")
        .join(wanted.hint("merge"), ["key", "digest"])
        .dropDuplicates(["digest"])
    )
    discard(found)
    cut = materialise(
        texts.select("digest", "text", "spots").mapInArrow(
            _cut_contexts(length), "digest binary, anchor long, first long, name binary, context binary"
        )
    )
    contexts = materialise(
        cut.groupBy("anchor", "name").agg(F.first("context").alias("context"), F.count("*").alias("count"))
    )
    placed = materialise(cut.select("digest", "anchor", "name", "first"))
    discard(cut)
    sizes = materialise(contexts.groupBy("anchor").agg(F.count("*").alias("n")))
    usual = contexts.join(sizes.where(F.col("n") <= max_contexts).select("anchor"), "anchor")
    merged = (
        usual.select("anchor", "name", "context", "count")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "name")
        .mapInArrow(_merge_contexts(length), "anchor long, name binary, runs array<struct<a: long, b: long>>")
    )
    crowded = contexts.join(sizes.where(F.col("n") > max_contexts).select("anchor"), "anchor")
    windows = crowded.select("anchor", "name", "context", "count").mapInArrow(
        _windows(length), "one long, two long, anchor long, name binary, start long, count long"
    )
    again = windows.groupBy("one", "two").agg(F.sum("count").alias("total")).where("total > 1")
    compared = (
        windows.join(again, ["one", "two"])
        .groupBy("anchor", "name")
        .agg(F.collect_list(F.struct(F.col("start").alias("a"), F.col("start").alias("b"))).alias("runs"))
    )
    runs = materialise(merged.unionByName(compared).where(F.size("runs") > 0))
    spans = (
        placed.join(runs, ["anchor", "name"])
        .select(
            "digest",
            F.transform(
                "runs",
                lambda r: F.struct((r["a"] + F.col("first")).alias("a"), (r["b"] + F.col("first")).alias("b")),
            ).alias("runs"),
        )
        .groupBy("digest")
        .agg(F.flatten(F.collect_list("runs")).alias("runs"))
    )
    judged = texts.select("digest", "text").join(spans, "digest").select(
        "digest", _covered(length)("text", "runs").alias("done")
    )
    changed = materialise(
        classes.join(judged, "digest", "left").where("copies > 1 OR done IS NOT NULL").select(
            "digest", "copies", "done"
        )
    )
    whole = F.col("copies") > 1
    n_bytes = F.octet_length("text").cast("long")
    return (
        source.select("id", "digest", n_bytes.alias("n_bytes"), F.sha2("text", 256).alias("sha"))
        .join(changed, "digest", "left")
        .select(
            F.col("id").alias(id_column),
            "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("done.removed", F.lit(0))).alias("n_removed"),
            F.when(whole, F.lit(1)).otherwise(F.coalesce("done.spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, F.lit(hashlib.sha256(b"").hexdigest()))
            .otherwise(F.coalesce("done.kept", "sha"))
            .alias("kept_sha256"),
        )
    )
