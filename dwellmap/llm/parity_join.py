"""Near-duplicate texts by Jaccard similarity of word shingles: a parity-sketch join.

Every shingle flips one bit of a bit sketch, so the Hamming distance of two sketches never exceeds the
symmetric difference of the two sets. A pair that is similar enough differs in at most D shingles,
where D follows from its sizes. Sizes are cut into bands; all sets of a band are dealt into more than
D blocks by their shingles' hashes, so a similar pair agrees on a whole block (pigeonhole), and blocks
are joined by equality of a 64-bit parity sketch. Candidates are compared by whole sketches, and those
that remain by their sets. No similar pair is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmap.functions.graph import connected_components
from dwellmap.llm.blocks import deal_blocks, whole_comparisons
from dwellmap.llm.texthash import mix, shingle_sets
from dwellmap.session import discard, materialise, prepare

_BAND_RATIO = 1.5
#: Members of a list that one task compares with each other at a time.
_LIST_PART = 1024
#: Least bytes of a sketch that a list's members carry; longer sketches are folded.
_BRIEF = 64
#: Parts in which keys, and lists, are dealt with one after another, so that less stands on disk at a time.
_KEY_PARTS = 2
#: Pairs whose sketches are compared at a time, at most.
_PAIRS = 1 << 15


def max_difference(total: int, percent: int) -> int:
    """Largest symmetric difference of two sets with this sum of sizes and the wanted similarity."""
    return total * (100 - percent) // (100 + percent)


@lru_cache
def bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower ends of the size bands, blocks in each, and how many of them a set leaves out.

    Sets below the first band are similar only if equal.
    """
    first = next(
        n for n in range(1, 10_000) if max_difference(n + (100 * n // percent), percent) > 0
        and 100 * n // percent > n
    )
    edges = [first]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * _BAND_RATIO)))
    blocks, spare = [], []
    for top in edges[1:]:
        d = max_difference((top - 1) + 100 * (top - 1) // percent, percent)
        spare.append(2 + d // 8)
        blocks.append(d + 1 + spare[-1])
    return np.array(edges[:-1]), np.array(blocks), np.array(spare)


def _signatures(tokens: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Keys of the blocks on which a similar set of the same band can agree.

    A block's key is the XOR of one 64-bit value per shingle: blocks with different shingles have
    different keys, however many sets there are. Every set leaves out its ``spare`` weakest blocks, by
    number of shingles and then by key: empty blocks and those with one shingle would agree with very
    many unrelated sets. A similar pair agrees on at least ``spare`` + 1 blocks, and the strongest of
    these, being above ``spare`` others in both sets, is left out of neither.
    """
    _, blocks, spare = bands(percent)
    count = int(blocks[band])
    block = ((tokens >> np.uint64(32)) % np.uint64(count)).astype(np.int64)
    values = mix(tokens + np.uint64(7919))
    order = np.argsort(block, kind="stable")
    sizes = np.bincount(block, minlength=count)
    parity = np.zeros(count, np.uint64)
    filled = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[filled]
    parity[filled] = np.bitwise_xor.reduceat(values[order], starts)
    keys = mix(mix(parity) + np.arange(count, dtype=np.uint64) + np.uint64(band << 48))
    return keys[np.lexsort((keys, sizes))[int(spare[band]) :]]


def describe(tokens: np.ndarray, percent: int) -> tuple[int, int, np.ndarray, bytes]:
    """Two digests of the set, its block keys and its parity sketch of about two bits per shingle."""
    n = len(tokens)
    mixed = mix(tokens + np.uint64(31))
    first = int(mixed.sum(dtype=np.uint64).view(np.int64)) if n else 0
    second = int(np.bitwise_xor.reduce(mixed).view(np.int64)) if n else 0
    edges, _, _ = bands(percent)
    keys = []
    if n >= edges[0]:
        band = int(np.searchsorted(edges, n, "right")) - 1
        keys.append(_signatures(tokens, band, percent))
        if band and -(-percent * n // 100) < edges[band]:
            keys.append(_signatures(tokens, band - 1, percent))
    bits = 64 << max(0, (max(n, 1) * 2 // 64).bit_length())
    flips = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    sketch = np.packbits(flips.astype(np.uint8)).tobytes()
    return first, second, np.concatenate(keys) if keys else np.zeros(0, np.uint64), sketch


def _brief_size(n: int, percent: int) -> int:
    """Bytes to which the sketch of ``n`` shingles is folded: at least four bits for each one in which a
    similar pair may differ, as unrelated sketches differ in about half of their bits."""
    size = _BRIEF
    while size * 2 < max_difference(n + 100 * n // percent, percent):
        size *= 2
    return size


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch as 64-bit words, folded to ``size`` bytes.

    Sizes are powers of two and bits are taken modulo the size, so halves fold by XOR.
    """
    words = np.frombuffer(sketch, np.uint64)
    while words.nbytes > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def sketch_distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two parity sketches; the longer one is folded to the shorter."""
    size = min(len(a), len(b))
    return int(np.bitwise_count(_folded(a, size) ^ _folded(b, size)).sum())


def _describe_all(percent: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            with np.errstate(over="ignore"):
                for tokens in shingle_sets(batch.column(1), words):
                    rows.append((len(tokens), *describe(tokens, percent)))
            if not rows:
                continue
            n, first, second, keys, sketches = zip(*rows, strict=True)
            lengths = np.cumsum([0, *map(len, keys)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(lengths, pa.int32()),
                        pa.array(np.concatenate(keys).view(np.int64), pa.int64()),
                    ),
                    pa.array(sketches, pa.binary()),
                    pa.array([_folded(s, _brief_size(m, percent)).tobytes() for m, s in zip(n, sketches, strict=True)], pa.binary()),
                ],
                ["id", "n", "d1", "d2", "keys", "sketch", "brief"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [t.tobytes() for t in shingle_sets(batch.column(1), words)]
            if sets:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sets, pa.binary())], ["id", "tokens"]
                )

    return run


def _near(percent: int):
    """Whether the sketches leave room for the wanted similarity."""

    @F.arrow_udf("boolean")
    def near(na: pa.Array, a: pa.Array, nb: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for n, x, m, y in zip(*(c.to_pylist() for c in (na, a, nb, b)), strict=True):
            out.append(sketch_distance(x, y) <= max_difference(n + m, percent))
        return pa.array(out, pa.bool_())

    return near


def _candidates(bounds: np.ndarray, side: np.ndarray, comp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one comparison in different components, a bounded number at a time.

    All comparisons step together: a row meets the one k places on, for k = 1, 2, ... In a comparison of
    two blocks, only rows of different sides meet.
    """
    ends = np.repeat(bounds[1:], np.diff(bounds))
    mixed = np.repeat(np.add.reduceat(side, bounds[:-1]) > 0, np.diff(bounds)) if len(side) else side
    rows, k = np.arange(len(ends)), 0
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    while True:
        k += 1
        rows = rows[rows + k < ends[rows]]
        if not len(rows):
            break
        other = rows + k
        meets = comp[rows] != comp[other]
        meets &= ~mixed[rows] | (side[rows] != side[other])
        if meets.any():
            held.append((rows[meets], other[meets]))
            waiting += len(held[-1][0])
        if waiting > _PAIRS:
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
            held, waiting = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


class _Briefs:
    """The folded sketches of many rows, as matrices by size."""

    def __init__(self, briefs: pa.ChunkedArray):
        raw = [b.as_py() for b in briefs]
        self.size = np.array([len(b) for b in raw], np.int64)
        self._by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in np.unique(self.size).tolist():
            rows = np.flatnonzero(self.size == size)
            words = np.frombuffer(b"".join([raw[r] for r in rows.tolist()]), np.uint64)
            self._by_size[size] = rows, words.reshape(len(rows), -1)
        self._folded: dict[int, np.ndarray] = {}

    def at(self, size: int) -> np.ndarray:
        """Sketches of ``size`` bytes by row; rows with smaller ones are blank."""
        if size not in self._folded:
            out = np.zeros((len(self.size), size // 8), np.uint64)
            for own, (rows, words) in self._by_size.items():
                while own > size:
                    half = words.shape[1] // 2
                    words, own = words[:, :half] ^ words[:, half:], own // 2
                if own == size:
                    out[rows] = words
            self._folded[size] = out
        return self._folded[size]

    def distances(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        size = np.minimum(self.size[a], self.size[b])
        for one in np.unique(size).tolist():
            words = self.at(one)
            here = np.flatnonzero(size == one)
            step = max(1, (1 << 22) // one)
            for i in range(0, len(here), step):
                at = here[i : i + step]
                out[at] = np.bitwise_count(words[a[at]] ^ words[b[at]]).sum(axis=1, dtype=np.int64)
        return out


def _open_pairs(percent: int):
    """Pairs of a list's members in different components whose sketches leave room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_comparisons(batches):
            briefs, n = _Briefs(table["brief"]), table["n"].to_numpy()
            comp = table["comp"].combine_chunks().dictionary_encode().indices.to_numpy()
            ids = table["id"].combine_chunks()
            for a, b in _candidates(bounds, table["side"].to_numpy(), comp):
                room = (n[a] + n[b]) * (100 - percent) // (100 + percent)
                # Sizes alone differ in no more than that.
                close = np.abs(n[a] - n[b]) <= room
                a, b, room = a[close], b[close], room[close]
                near = briefs.distances(a, b) <= room
                if near.any():
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(a[near])), ids.take(pa.array(b[near]))], ["a", "b"]
                    )

    return run


def _similar(percent: int):
    @F.arrow_udf("boolean")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    return similar


def near_groups(
    docs: DataFrame,
    percent: int = 80,
    words: int = 5,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id``, the smallest id it reaches.

    Documents link when 100 * |A and B| >= percent * |A or B| for their sets of ``words``-word
    shingles (words are runs of characters other than ASCII white space, A-Z lower-cased; a shorter
    text is one shingle). Texts without words, and null, link with nothing.

    Equal sets form classes first, by aggregation, and only one member of each goes on. The members
    of a shared block are first compared with one of them: a group of thousands of near copies falls
    into few components after about as many comparisons as it has members. Where a block's members
    still stand apart, all of them in different components are compared by sketch, in tasks of bounded
    size, and only pairs close enough to be similar are listed and compared by their sets. The
    components are thus those of all links, without listing them. Rows with a null id link with
    nothing; rows that repeat an id are one document.
    """
    prepare(docs.sparkSession)
    name = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    described = materialise(
        source.mapInArrow(
            _describe_all(percent, words),
            f"id {name}, n long, d1 long, d2 long, keys array<long>, sketch binary, brief binary",
        )
    )
    group = ["n", "d1", "d2"]
    classes = materialise(
        described.where("n > 0 AND id IS NOT NULL").groupBy(*group).agg(F.min("id").alias("rep"))
    )
    reps = described.join(
        classes.withColumnRenamed("rep", "id"), [*group, "id"], "left_semi"
    ).dropDuplicates(["id", *group])
    parts = []
    for part in range(_KEY_PARTS):
        own = F.expr(f"filter(keys, k -> pmod(k, {_KEY_PARTS}) = {part})")
        keyed = reps.select("id", F.explode(own).alias("key"))
        # Written, so that the shuffles of the keys for counting and for joining don't stand side by side.
        shared = materialise(
            keyed.groupBy("key").agg(F.count("*").alias("c"), F.min("id").alias("hub")).where("c > 1")
            .select("key", "hub")
        )
        parts.append(materialise(keyed.join(shared, "key").select("key", "id", "hub").distinct()))
        discard(shared)
    members = parts[0]
    for part in parts[1:]:
        members = members.unionByName(part)
    # The keys are the bulk of what was described, and done with.
    slim = materialise(described.drop("keys"))
    discard(described)
    described = slim
    ids = members.select("id").distinct()
    sketches = materialise(described.join(ids, "id", "left_semi").select("id", "n", "sketch", "brief"))

    def side(table: DataFrame, tag: str) -> DataFrame:
        return table.select(*[F.col(c).alias(tag if c == "id" else f"{tag}_{c}") for c in table.columns])

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are similar enough."""
        known = sketches.drop("brief")
        sketched = pairs.join(side(known, "b"), "b").join(side(known, "a"), "a")
        room = materialise(
            sketched.where(_near(percent)("a_n", "a_sketch", "b_n", "b_sketch")).select("a", "b")
        )
        close = room.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = materialise(
            source.join(close.hint("merge"), "id", "left_semi").mapInArrow(
                _sets(words), f"id {name}, tokens binary"
            )
        )
        full = room.join(side(sets, "b"), "b").join(side(sets, "a"), "a")
        links = materialise(full.where(_similar(percent)("a_tokens", "b_tokens")).select("a", "b").distinct())
        discard(room, sets)
        return links

    def components(links: DataFrame) -> DataFrame:
        edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        return connected_components(edges, [])

    hubs = members.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    links = verified(materialise(hubs))
    component = components(links).withColumnsRenamed({"u": "id", "component": "comp"})
    labelled = materialise(
        members.select("key", "id").join(component, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    )
    # Lists of two were settled with their hub, and lists of the same members need one look.
    name_sum, name_xor = F.xxhash64("id", F.lit(1)), F.xxhash64("id", F.lit(2))
    lists = (
        labelled.groupBy("key")
        .agg(
            F.count("*").alias("c"),
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
            F.sum(F.shiftright(name_sum, 24)).alias("s"),
            F.bit_xor(name_xor).alias("x"),
        )
        .where("c > 2 AND low <> high")
        .groupBy("c", "s", "x")
        .agg(F.min("key").alias("key"))
    )
    apart = materialise(labelled.join(lists.select("key"), "key"))
    found = []
    for part in range(_KEY_PARTS):
        own = apart.where(F.pmod("key", F.lit(_KEY_PARTS)) == part)
        open_pairs = deal_blocks(own, _LIST_PART, sketches.drop("sketch")).mapInArrow(
            _open_pairs(percent), f"a {name}, b {name}"
        )
        found.append(
            materialise(open_pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        )
    pairs = found[0]
    for part in found[1:]:
        pairs = pairs.unionByName(part)
    pairs = pairs.distinct()
    component = components(links.union(verified(pairs)))
    resolved = materialise(
        classes.join(component.withColumnRenamed("u", "rep"), "rep", "left").select(
            *group, F.coalesce("component", "rep").alias("class_component")
        )
    )
    alone = F.col("id").isNull() | (F.col("n") == 0)
    joined = described.select("id", *group).join(resolved, group, "left")
    return joined.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("class_component")).alias("component_id"),
    )
