import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dwellmap.llm import suffix_dedup


def brute(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 2, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[1 + p : 1 + p + length] = True
        kept = bytes(x for x, g in zip(b, gone[1:-1], strict=True) if not g)
        spans = int((np.diff(gone.astype(int)) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(rng, size=60):
    letters = list("abcdé \n")
    passages = ["".join(rng.choice(letters, n)) for n in (30, 45, 80, 200)]
    rows = []
    for i in range(size):
        parts = []
        for _ in range(int(rng.integers(0, 5))):
            parts.append("".join(rng.choice(letters, int(rng.integers(0, 60)))))
            if rng.random() < 0.6:
                passage = passages[int(rng.integers(len(passages)))]
                cut = int(rng.integers(0, 12))
                parts.append(passage[cut : len(passage) - int(rng.integers(0, 12))])
        rows.append((i, "".join(parts)))
    rows += [(size + i, rows[i][1]) for i in range(0, 20, 4)]
    return rows + [(900, None), (901, ""), (902, "ab" * 90), (903, "x" * 70), (904, "x" * 25), (905, "xy")]


@pytest.mark.parametrize("max_contexts", [4096, 2])
def test_matches_all_strings(spark, max_contexts):
    rows = corpus(np.random.default_rng(max_contexts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, 25, max_contexts=max_contexts).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 25)


def test_long_strings(spark):
    rng = np.random.default_rng(4)
    word = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(900)]
    passage = " ".join(rng.choice(word, 120))
    rows = [(i, " ".join(rng.choice(word, 200)) + passage[i * 7 :] + " ".join(rng.choice(word, 90))) for i in range(25)]
    rows += [(100, rows[0][1][:399]), (101, rows[0][1][:400]), (102, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 400)


def test_edge_rows(spark):
    schema = "digest string, doc_id long, text string, key string"
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, None, "ab" * 300, None), (None, 1, "c" * 399, None), (None, 2, None, None)]
    rows += [(None, 3, "".join(map(str, range(500))), "k")] * 2
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r[0] or 0, *r[1:4]) for r in got) == [
        (0, 600, 600, 1), (1, 399, 0, 0), (2, 0, 0, 0), (3, 1390, 1390, 1), (3, 1390, 1390, 1)
    ]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=8, max_size=40), min_size=1, max_size=12, unique=True), st.integers(1, 4))
def test_merge_equals_counting(texts, per_shard):
    contexts = [t.encode() for t in texts]
    shards = [suffix_dedup.Shard(contexts[i : i + per_shard], 8) for i in range(0, len(contexts), per_shard)]
    known = suffix_dedup.merge(shards, 8)
    at, seen = 0, {}
    for number, shard in enumerate(shards):
        text = b"\0".join(contexts[number * per_shard : (number + 1) * per_shard]) + b"\0"
        for row, position in enumerate(shard.order):
            end = text.index(b"\0", position)
            string = text[position : min(end, position + 8)]
            seen.setdefault(string, set()).add(int(known[at + row]))
        at += len(shard.order)
    assert all(len(s) == 1 for s in seen.values())
    assert [min(seen[s]) for s in sorted(seen)] == list(range(len(seen)))


def test_transform_and_jumps():
    shard = suffix_dedup.Shard([b"banana", b"ananas"], 8)
    text = b"banana\0ananas\0"
    assert sorted(shard.transform) == sorted(0 if c == 0 else c + 1 for c in text)
    for row, later in enumerate(shard.jump(2)):
        assert shard.order[later] == min(shard.order[row] + 2, shard.end[shard.order[row]])
