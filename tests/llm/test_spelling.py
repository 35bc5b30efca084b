"""Spelling variants against edits made and looked up one by one."""

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dwellmap.llm.queries import op13_spelling_variants
from dwellmap.llm.spelling import letter_runs, misspelt, trie_nodes, variant_groups, word_counts

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def expected(counts):
    letters = set("".join(counts))
    form, near = {}, {}
    for w in counts:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + a + w[i + 1 :] for i in range(len(w)) for a in letters}
        edits |= {w[:i] + a + w[i:] for i in range(len(w) + 1) for a in letters}
        edits = [x for x in edits if x != w and x in counts]
        best = min(edits, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
        near[w] = len(edits)

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, near[w], counts.get(form[w])) for w, n in counts.items()}


def count_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def groups(spark, counts, partitions=5):
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(partitions)
    return [tuple(r) for r in variant_groups(df).select(COLUMNS).collect()]


def test_query_against_edits(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in op13_spelling_variants(spark, folder).select(COLUMNS).collect()]
    want = expected(count_words(docs))
    assert len(got) == len(want) and set(got) == want
    assert sum(1 for r in got if r[1] is not None) > 50


def test_dense_vocabularies(spark):
    draw = random.Random(3)
    words = {"".join(draw.choice("abÿ") for _ in range(draw.randint(0, 8))) for _ in range(4000)}
    counts = {w: draw.choice([1, 2, 3, 5, 8, 100, 250]) for w in sorted(words)}
    got = groups(spark, counts)
    assert len(got) == len(counts) and set(got) == expected(counts)


def test_long_chains_of_forms(spark):
    counts = {"aaaaa" + "b" * i: 3 << i for i in range(20)}
    got = {r[0]: r for r in groups(spark, counts)}
    assert got["aaaaa"][1:3] == ("aaaaab", "aaaaa" + "b" * 19)
    assert set(got.values()) == expected(counts)


def test_very_long_words_and_none(spark):
    long = "abc" * 4000
    counts = {long: 9, long + "d": 3, "x" + long[1:]: 4, "other": 7}
    got = {r[0]: r for r in groups(spark, counts, 2)}
    assert got[long] == (long, None, long, 9, 2, None)
    assert got[long + "d"][1] == long and got["x" + long[1:]][1] == long and got["other"][4] == 0
    none = spark.createDataFrame([], "word string, n long")
    assert variant_groups(none).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aZÉ×ÿĀ'·İß5 \x85\U0001f600"), max_size=30))
def test_runs_of_letters(text):
    found = [r.decode("latin-1") for r in letter_runs(text)]
    want = re.findall("[A-Za-zÀ-ÿ]+", text)
    assert found == [re.sub("[A-Z]", lambda m: m[0].lower(), r) for r in want]


def test_one_pair_in_97_loses_a_character():
    changed = [i for i in range(9700) if misspelt(i, b"h\xe9llo") != b"h\xe9llo"]
    assert 60 < len(changed) < 140
    h = zlib.crc32(f"{changed[0]}:héllo".encode())
    assert misspelt(changed[0], b"h\xe9llo").decode("latin-1") == "héllo"[: h % 5] + "héllo"[h % 5 + 1 :]


def test_node_numbers_stand_for_prefixes(spark):
    draw = random.Random(4)
    words = sorted({"".join(draw.choice("abé") for _ in range(draw.randint(0, 9))) for _ in range(3000)})
    rows = trie_nodes(
        spark.createDataFrame([(w,) for w in words], "word string").select(F.lit(0).cast("long").alias("no"), "word"), 7
    ).collect()
    prefix = {}
    for r in rows:
        for k, node in enumerate(r.nodes):
            assert prefix.setdefault(node, r.word[:k]) == r.word[:k]
    assert len(set(prefix.values())) == len(prefix) == max(prefix) + 1
    assert {r["rank"]: r.word for r in rows} == dict(enumerate(words))


def test_odd_rows(spark):
    rows = [
        (1, None, "a"), (2, "", "a"), (None, "Hello, HELLO hello", "a"), (3, "hello ÀÉÎ÷Õ hell0 hello", None),
        (3, "hello ÀÉÎ÷Õ hell0 hello", None), (4, "àéîõÿ " * 3, "b"), (5, "1234 -- ???", "b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    counts = {r.word: r.n for r in word_counts(docs).collect()}
    assert counts == {"hello": 7, "àéîõÿ": 3}
    assert word_counts(docs.limit(0)).collect() == []
    assert word_counts(docs, min_count=1, rewrite=misspelt).count() >= 2
