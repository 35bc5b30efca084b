from collections import defaultdict

import pytest
from test_packing import check
from test_parity_join import brute

import corpus_pipeline
from dwellmap.session import materialise

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(materialise(stage(spark, tables[-1], SF_DIR)))
    return [[r.asDict() for r in t.collect()] for t in tables]


def test_columns(stages):
    for rows in stages[1:-1]:
        assert set(rows[0]) == {"doc_id", "text", "lang", "source", "n_chars"}


def test_language_keeps_nearly_all(stages):
    before, after = ({r["doc_id"]: r for r in rows} for rows in stages[:2])
    assert all(before[i] == r for i, r in after.items())
    gone = [r for i, r in before.items() if i not in after]
    assert all(len(r["text"]) < 40 for r in gone) and len(gone) < 0.02 * len(before)


def test_lines(stages):
    sites = defaultdict(set)
    for r in stages[1]:
        for line in r["text"].split("\n"):
            if len(line.strip(" \t\r\f\v")) >= 12:
                sites[line.strip(" \t\r\f\v")].add(r["source"])
    spread = {line for line, s in sites.items() if len(s) >= 10}
    after = {r["doc_id"]: r for r in stages[2]}
    assert len(after) == len(stages[1])
    for r in stages[1]:
        lines = r["text"].split("\n")
        kept = [x for x in lines if x.strip(" \t\r\f\v") not in spread]
        size = sum(len(x.strip(" \t\r\f\v")) for x in lines)
        enough = sum(len(x.strip(" \t\r\f\v")) for x in kept) >= 0.5 * size
        want = "\n".join(kept) if enough and len(kept) < len(lines) else r["text"]
        assert after[r["doc_id"]]["text"] == want
        assert after[r["doc_id"]]["n_chars"] == len(want)


def test_near_duplicates(stages):
    want = {i for i, _, c in brute([(r["doc_id"], r["text"]) for r in stages[2]], 80, 5) if i == c}
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(want)


def test_mixture(stages):
    once, copies = {r["doc_id"]: r for r in stages[3]}, defaultdict(int)
    for r in stages[4]:
        assert r == once[r["doc_id"]]
        copies[r["doc_id"]] += 1
    assert set(copies) == set(once) and set(copies.values()) <= {1, 2}


def test_packing(spark, stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[4]]
    total = sum(r["length"] for r in stages[5])
    tokens = {r["doc_id"]: r["doc_tokens"] for r in stages[5]}
    assert total == sum(tokens[i] for i, _ in rows)
    once = spark.createDataFrame([(r["doc_id"], r["text"]) for r in stages[3]], "doc_id long, text string")
    pieces = corpus_pipeline.pack_sequences(spark, once, SF_DIR).collect()
    assert check([(r["doc_id"], r["text"]) for r in stages[3]], pieces) < 0.02 * total


def test_stages_handle_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], schema)
    long = "the of and " * 60_000
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the words of a text here and there", "en", "s", 34)]
    rows += [(3, "the words of a text, and more of the words", "en", None, 9)] * 2 + [(4, long, "en", "s", len(long))]
    rows += [(5, "die der das und nicht von dem", "de", "t", 3), (None, "der die das", None, None, None)]
    odd = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        for table in (empty, odd):
            out = stage(spark, table, SF_DIR)
            count = out.count()
            if name != "pack":
                assert out.columns == odd.columns
            if name in ("line_dedup", "mix_sources") and table is odd:
                assert count >= len(rows)
            if name == "near_duplicates" and table is odd:
                assert count == len(rows) - 1
            assert count > 0 or table is empty
