"""Periodic runs against a search of all periods, and odd rows."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dwellmap.llm.queries import op11_periodic_runs
from dwellmap.llm.runs import LinkCutTree, collapse, continued, periodic_runs, runs_of, runs_of_all, split_words


def all_runs(words, min_length=6, min_exponent=4):
    """Every maximal stretch in which words q apart are equal, for every q, unless a smaller q will do."""
    found = []
    for q in range(1, len(words) // min_exponent + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            end = i
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            start, length = i - q, end - i + q
            smaller = any(
                all(words[k] == words[k - d] for k in range(start + d, end)) for d in range(1, q)
            )
            if length >= max(min_length, min_exponent * q) and not smaller:
                found.append((start, length, q))
            i = end
    return sorted(found)


def expected(doc_id, text):
    words = continued(doc_id, split_words(text))
    runs = all_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        len(runs),
        *best,
        best[1] * 1000 // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


sequences = st.lists(
    st.tuples(st.lists(st.integers(0, 3), max_size=8), st.integers(1, 9)), max_size=5
).map(lambda parts: [w for part, times in parts for w in part * times])


@settings(max_examples=300, deadline=None)
@given(st.lists(sequences, max_size=4), st.integers(2, 4), st.sampled_from([2, 6, 9]))
def test_equal_to_a_search_of_all_periods(docs, exponent, length):
    texts = [[b"w%d" % w for w in words] for words in docs]
    assert runs_of_all(texts, length, exponent) == [all_runs(d, length, exponent) for d in docs]
    for words in docs:
        assert runs_of(words, length, exponent) == all_runs(words, length, exponent)


def test_long_periods_and_neighbouring_texts():
    draw = random.Random(5)
    passage = [b"%d" % draw.randrange(30) for _ in range(700)]
    other = [b"%d" % draw.randrange(30) for _ in range(3000)]
    texts = [other + passage * 4, passage * 2, passage * 3, passage * 5 + other, [b"x"] * 20_000]
    found = runs_of_all(texts)
    assert (3000, 2800, 700) in found[0] and not any(q == 700 for _, _, q in found[1] + found[2])
    assert (0, 3500, 700) in found[3] and found[4] == [(0, 20_000, 1)]


def test_access_tells_earlier_ends_from_below():
    tree = LinkCutTree([-1, 0, 1, 1, 0])  # 0 over 1 and 4, 1 over 2 and 3
    assert tree.access(2, 7) == []
    assert tree.access(3, 8) == [(1, 7)]
    assert tree.access(4, 9) == [(0, 8)]
    assert tree.access(2, 10) == [(2, 7), (1, 8), (0, 9)]


def test_a_run_is_collapsed_to_its_first_period():
    words = list("xabababab") + ["y"]
    assert collapse(words, runs_of([ord(w) for w in words])) == list("xab") + ["y"]


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in op11_periodic_runs(spark, folder).collect()}
    assert got.keys() == docs.keys()
    for doc_id, text in docs.items():
        # The search of all periods is too slow for long texts that are one run.
        if len(split_words(text)) <= 1500:
            assert got[doc_id] == expected(doc_id, text)
    assert sum(1 for r in got.values() if r[0]) > 10


def test_odd_rows(spark):
    rows = [
        (1, None, "a"),
        (2, "", None),
        (3, " \t\n ", "b"),
        (3, "go on\tgo on\ngo on go on stop", "b"),
        (3, "go on\tgo on\ngo on go on stop", "b"),
        (None, "é ü " * 9, "b"),
        (7, "la " * 60_000, "c"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string")
    got = periodic_runs(docs, with_text=True).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == len(rows)
    assert [(r.n_words, r.n_runs, r.start, r.runs_sha256, r.collapsed) for r in got[:3]] == [
        (0, 0, None, empty, "")
    ] * 3
    assert [(r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.collapsed) for r in got[3:]] == [
        (1, 0, 8, 2, 4000, "go on stop"),
        (1, 0, 8, 2, 4000, "go on stop"),
        (1, 0, 9, 1, 9000, "é ü"),
        (1, 0, 60_000, 1, 60_000_000, "la"),
    ]
    assert periodic_runs(docs.limit(0)).collect() == []
