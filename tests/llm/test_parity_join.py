import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dwellmap.llm import parity_join


def shingles(text, k):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or {tuple(words)}


def brute(rows, percent, k):
    sets = [(i, shingles(t, k)) for i, t in rows]
    best = {i: i for i, _ in rows}
    links = [
        (i, j)
        for n, (i, a) in enumerate(sets)
        for j, b in sets[n + 1 :]
        if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b)
    ]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(best[i], best[j])
            changed |= best[i] != low or best[j] != low
            best[i] = best[j] = low
    return {(i, len(s), best[i]) for i, s in sets}


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for size in (3, 8, 9, 10, 11, 12, 25, 40, 90, 200, 700):
        for _ in range(6):
            base = list(rng.choice(vocabulary, size))
            for copy in range(4):
                words = list(base)
                for at in rng.integers(0, size, rng.integers(0, 2 + size // 40)):
                    words[at] = f"x{rng.integers(9)}"
                words += list(rng.choice(vocabulary, rng.integers(0, 1 + size // 12)))
                rows.append((len(rows), (" " if copy else "\n").join(words)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \t"), (len(rows) + 3, "A b"), (len(rows) + 4, "a  B")]
    return rows


@pytest.mark.parametrize("percent,k,part", [(90, 3, 1024), (80, 5, 1024), (80, 3, 3)])
def test_matches_all_pairs(spark, monkeypatch, percent, k, part):
    monkeypatch.setattr(parity_join, "_LIST_PART", part)
    rows = corpus(np.random.default_rng(5))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in parity_join.near_groups(docs, percent, k).collect()}
    assert got == brute(rows, percent, k)


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(1)
    base = [f"v{i}" for i in rng.integers(0, 5000, 150)]
    rows = []
    for i in range(400):
        words = list(base)
        words[int(rng.integers(150))] = f"z{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = parity_join.near_groups(docs, 90, 3).collect()
    assert len(got) == 700 and {r.component_id for r in got} == {0}


def test_edge_rows(spark):
    schema = "extra string, doc_id long, text string, n long, keys string"
    assert parity_join.near_groups(spark.createDataFrame([], schema)).collect() == []
    rows = [("e", None, "a b c d e f g", 1, "k"), ("e", 5, "a b c d e f g", 1, "k")] * 2
    rows += [(None, 3, "A B c d e f g", None, None), ("e", 7, "x" * 300_000, 1, "k")]
    got = parity_join.near_groups(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r[0] or 0, r[1], r[2] or 0) for r in got) == [
        (0, 3, 0), (0, 3, 0), (3, 3, 3), (5, 3, 3), (5, 3, 3), (7, 1, 7)
    ]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(9, 300), st.sampled_from([80, 90]))
def test_similar_sets_share_a_block(seed, size, percent):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
    drop = int(rng.integers(0, 1 + size * (100 - percent) // 100))
    b = np.union1d(a[drop // 2 :], rng.integers(0, 2**63, drop - drop // 2).astype(np.uint64))
    both = len(np.intersect1d(a, b))
    if 100 * both < percent * (len(a) + len(b) - both) or len(a) == len(b) == both:
        return
    with np.errstate(over="ignore"):
        x, y = parity_join.describe(a, percent), parity_join.describe(b, percent)
    assert np.intersect1d(x[2], y[2]).size
    distance = parity_join.sketch_distance(x[3], y[3])
    assert distance <= len(a) + len(b) - 2 * both


def test_long_texts_of_a_list_are_told_apart_by_their_sketches():
    rng = np.random.default_rng(5)
    for percent, n in ((80, 1500), (80, 9000), (90, 4000), (90, 30_000)):
        sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(12)]
        sets.append(np.concatenate([sets[0][: n - n // 50], sets[1][: n // 50]]))
        texts = [" ".join(f"{x:x}" for x in tokens) for tokens in sets]
        batch = pa.RecordBatch.from_arrays([pa.array(range(13)), pa.array(texts)], ["id", "text"])
        described = pa.Table.from_batches(parity_join._describe_all(percent, 1)(iter([batch])))
        parts = {"key": [7] * 13, "i": [0] * 13, "j": [0] * 13, "side": [0] * 13, "comp": list(range(13))}
        members = pa.table(parts | {c: described[c].combine_chunks() for c in ("id", "n", "brief")})
        pairs = pa.Table.from_batches(parity_join._open_pairs(percent)(iter(members.to_batches())))
        assert pairs.to_pylist() == [{"a": 0, "b": 12}]


@pytest.mark.parametrize("percent", [80, 90])
def test_unrelated_sets_share_no_block(percent):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in range(60, 1000)]
    # The same blocks and the same low bytes, but not one shingle in common.
    sets += [np.unique(s ^ np.uint64(256)) for s in sets]
    with np.errstate(over="ignore"):
        keys = np.concatenate([np.unique(parity_join.describe(s, percent)[2]) for s in sets])
    shared = len(keys) - np.count_nonzero(np.unique(keys, return_counts=True)[1] == 1)
    assert shared < 0.001 * len(keys)


@pytest.mark.parametrize("percent", [80, 90])
def test_just_similar_sets_share_a_block(percent):
    rng = np.random.default_rng(9)
    tried = 0
    with np.errstate(over="ignore"):
        for n in [*range(4, 70), 130, 420, 1400]:
            for m in {n, n * 100 // percent, n + int(rng.integers(0, 1 + n // 9))}:
                # As few in common as a similar pair can have.
                both = -(-percent * (n + m) // (100 + percent))
                if both > n:
                    continue
                for _ in range(20):
                    tokens = rng.integers(0, 1 << 63, n + m - both).astype(np.uint64)
                    a, b = np.sort(tokens[:n]), np.sort(tokens[n - both :])
                    if len(a) == both == len(b):
                        continue
                    tried += 1
                    x, y = parity_join.describe(a, percent)[2], parity_join.describe(b, percent)[2]
                    assert np.intersect1d(x, y).size, (n, m, both)
    assert tried > 500
