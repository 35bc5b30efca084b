"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points (pivots). Two vectors are candidates when
they share at least three of them. Inverted lists are kept for triples of pivots rather than single
pivots: lists stay short, and a pair's shared-pivot count reaches three exactly when it meets in some
list. Candidates are verified by their cosine in double precision.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmap.functions.graph import connected_components
from dwellmap.llm.blocks import comparisons, deal_blocks
from dwellmap.llm.sampling import hash_sample_by
from dwellmap.session import materialise, prepare

SHARED = 3
#: Members of a list that one task compares with each other at a time.
BLOCK = 1024
#: A list's key is the length of its vectors above this many bits, and the numbers of its pivots in them.
_KEY_BITS = 12 * SHARED


def index_size(vectors: int) -> tuple[int, int]:
    """Pivots, and nearest pivots that describe a vector: about the root of the number of vectors."""
    pivots = min(2048, max(64, 1 << round(math.log2(math.sqrt(max(vectors, 1))))))
    return pivots, 8 if pivots <= 256 else 10


def unit(vector: list | None) -> np.ndarray | None:
    """The vector with length 1, or None if it links with nothing."""
    if vector is None or any(x is None for x in vector):
        return None
    found = np.array(vector, np.float64)
    if not len(found) or not np.isfinite(found).all():
        return None
    largest = np.abs(found).max()
    if not largest:
        return None
    found = found / largest
    return found / math.sqrt(found @ found)


def choose_pivots(sample: list[np.ndarray], wanted: int) -> np.ndarray:
    """The first vectors of the sample that are not close to one chosen before.

    Without that rule a large group of near copies would supply many pivots that can't tell its
    members apart from each other consistently. The rule is relaxed until enough are found.
    """
    if not sample:
        return np.zeros((0, 0))
    pool = np.stack(sample)
    chosen: list[int] = []
    for closest in (0.5, 0.7, 0.85):
        best = (pool @ pool[chosen].T).max(axis=1) if chosen else np.full(len(pool), -2.0)
        for i in range(len(pool)):
            if len(chosen) >= wanted:
                break
            if best[i] < closest:
                chosen.append(i)
                best = np.maximum(best, pool @ pool[i])
    return pool[chosen or [0]]


def _described(pivots: dict[int, np.ndarray], near: dict[int, int]):
    """Units and nearest pivots; pivots are those of the vector's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [unit(v) for v in batch.column(1).to_pylist()]
            raw = [None if u is None else u.tobytes() for u in units]
            tops: list[bytes | None] = [None if u is None else b"" for u in units]
            lengths = np.array([0 if u is None else len(u) for u in units])
            for length in np.unique(lengths[lengths > 0]).tolist():
                if length not in pivots:
                    continue
                rows = np.flatnonzero(lengths == length).tolist()
                stacked = np.stack([units[i] for i in rows])
                order = np.argsort(-(stacked @ pivots[length].T), axis=1, kind="stable")
                for i, top in zip(rows, np.sort(order[:, : near[length]], axis=1), strict=True):
                    tops[i] = top.astype("<u2").tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary()), pa.array(tops, pa.binary())],
                ["id", "unit", "top"],
            )

    return run


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tops = [np.frombuffer(t, "<u2").astype(np.int64) for t in batch.column(1).to_pylist()]
        lengths = np.array(batch.column(2).to_pylist(), np.int64)
        counts = np.array([len(t) for t in tops], np.int64)
        for near in np.unique(counts).tolist():
            own = np.flatnonzero(counts == near)
            places = np.array(list(itertools.combinations(range(near), SHARED)), int)
            if not len(places):
                places = np.zeros((1, 0), int)
            picked = np.stack([tops[i] for i in own.tolist()])[:, places]
            keys = np.zeros(picked.shape[:2], np.int64)
            for i in range(places.shape[1]):
                keys = keys * 4096 + picked[:, :, i] + 1
            keys += lengths[own][:, None] << _KEY_BITS
            rows = np.repeat(own, keys.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), batch.column(0).take(pa.array(rows))], ["key", "id"]
            )


def compare(
    key: int, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], same: bool, least: float
) -> np.ndarray:
    """Which of the members (units, nearest pivots) of two blocks of a list link, as a matrix.

    A pair meets in the list of every triple it shares; it counts in the first of them only, the one
    of its three lowest shared pivots. ``same`` tells that both blocks are one: then only pairs above
    the diagonal count.
    """
    linked = a[0] @ b[0].T >= least
    triple = []
    key &= (1 << _KEY_BITS) - 1
    while key:
        triple.append(key % 4096 - 1)
        key //= 4096
    if triple:
        top = triple[0]  # the highest of the three
        earlier = [np.where((m <= top) & ~np.isin(m, triple), m, -1) for m in (a[1], b[1])]
        names = np.unique(np.concatenate([e.ravel() for e in earlier]))
        names = names[names >= 0]
        if len(names):
            flags = [(e[:, :, None] == names).any(axis=1).astype(np.float32) for e in earlier]
            linked &= flags[0] @ flags[1].T == 0
    if same:
        linked = np.triu(linked, 1)
    return linked


def _roots(linked: np.ndarray, n: int, same: bool) -> list[tuple[int, int]]:
    """Edges that keep the members of a comparison connected as the linked pairs do."""
    parent = list(range(n if same else n + linked.shape[1]))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        x, y = find(int(i)), find(int(j) if same else n + int(j))
        if x != y:
            parent[max(x, y)] = min(x, y)
            edges.append((int(i), int(j) if same else n + int(j)))
    return edges


def _verify(least: float):
    """Compare the blocks of lists; emit per member its links, and connecting edges."""

    def opened(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        units = np.stack([np.frombuffer(u.as_py(), np.float64) for u in table["unit"]])
        tops = np.stack([np.frombuffer(t.as_py(), "<u2").astype(np.int64) for t in table["top"]])
        return table["id"].combine_chunks(), units, tops, table["size"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, other in comparisons(batches):
            if len(one) < 2 and other is None or not len(one) or other is not None and not len(other):
                continue
            same = other is None
            ids, units, tops, sizes = opened(one)
            ids2, units2, tops2, sizes2 = (ids, units, tops, sizes) if same else opened(other)
            linked = compare(one["key"][0].as_py(), (units, tops), (units2, tops2), same, least)
            if not linked.any():
                continue
            counts = linked.astype(np.int64) @ sizes2
            back = sizes @ linked.astype(np.int64)
            total = counts + back if same else np.concatenate([counts, back])
            names = ids if same else pa.concat_arrays([ids, ids2])
            found = np.flatnonzero(total)
            edges = np.array(_roots(linked, len(ids), same), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    names.take(pa.array(np.concatenate([found, edges[:, 0]]))),
                    pa.concat_arrays([pa.nulls(len(found), names.type), names.take(pa.array(edges[:, 1]))]),
                    pa.array(np.concatenate([total[found], np.zeros(len(edges), np.int64)])),
                ],
                ["u", "v", "links"],
            )

    return run


def near_vectors(
    vectors: DataFrame,
    least: float = 0.9,
    id_column: str = "vec_id",
    vector: str = "embedding",
    sample_vectors: int = 8192,
) -> DataFrame:
    """One row per vector: id, ``n_links`` (other vectors with cosine >= ``least`` found),
    ``component_id`` (smallest id reachable by links) and ``kept`` (it is its own component id).

    Null and zero vectors and vectors with null or non-finite components link with nothing, and vectors
    of different lengths don't link with each other. Equal vectors form a class first, of which one member
    is indexed; a class of any size costs one list entry. Pivots are chosen for each length, from a sample
    of about ``sample_vectors`` distinct vectors in all, by the order of a hash (but at least 256 of a
    length); every vector is indexed. Lists longer
    than 1024 are compared block by block in separate tasks, so no task holds a long list, and every
    pair is counted in one list only. Rows that repeat an id count as vectors each; rows with a null
    id link with nothing.
    """
    name = vectors.schema[id_column].dataType.simpleString()
    source = vectors.select(
        F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("embedding")
    )
    usable = source.where(
        F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    prepare(vectors.sparkSession)
    sample, sizes = hash_sample_by(
        usable.select("embedding", F.size("embedding").alias("length")), "length", ["embedding"], sample_vectors, 256
    )
    pools: dict[int, list[np.ndarray]] = {}
    for row in sample.toArrow().sort_by([("length", "ascending"), ("h", "ascending")]).to_pylist():
        found = unit(row["embedding"])
        if found is not None:
            pools.setdefault(len(found), []).append(found)
    pivots: dict[int, np.ndarray] = {}
    near: dict[int, int] = {}
    for length, pool in pools.items():
        wanted, nearest = index_size(sizes[length])
        pivots[length] = choose_pivots(pool, wanted)
        near[length] = min(nearest, len(pivots[length]))

    described = materialise(
        source.mapInArrow(_described(pivots, near), f"id {name}, unit binary, top binary").withColumn(
            "class", F.sha2("unit", 256)
        )
    )
    classes = materialise(
        described.where("id IS NOT NULL AND unit IS NOT NULL")
        .groupBy("class")
        .agg(F.min("id").alias("rep"), F.count("*").alias("size"))
    )
    reps = materialise(
        described.join(classes.withColumnRenamed("rep", "id"), ["class", "id"]).dropDuplicates(["class"])
        .select("id", "unit", "top", "size")
    )
    length = F.expr("octet_length(unit) DIV 8").cast("long")
    postings = reps.select("id", "top", length.alias("length")).mapInArrow(_triples, f"key long, id {name}").select("key", "id")
    postings = materialise(postings)
    lists = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = postings.join(lists.select("key"), "key").join(reps, "id")
    placed = deal_blocks(members.select("key", "id", "unit", "top", "size"), BLOCK)
    verified = materialise(placed.mapInArrow(_verify(least), f"u {name}, v {name}, links long"))
    counts = verified.where("v IS NULL").groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    component = connected_components(verified.where("v IS NOT NULL").select("u", "v"), [])
    resolved = materialise(
        classes.join(counts, "rep", "left")
        .join(component.withColumnRenamed("u", "rep"), "rep", "left")
        .select(
            "class",
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("class_links"),
            F.coalesce("component", "rep").alias("class_component"),
        )
    )
    joined = described.select("id", "class").join(resolved, "class", "left")
    linkable = F.col("id").isNotNull()
    component_id = F.when(linkable, F.coalesce("class_component", "id"))
    return joined.select(
        F.col("id").alias(id_column),
        F.when(linkable, F.coalesce("class_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.coalesce(F.col("id") == component_id, F.lit(False)).alias("kept"),
    )
