import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dwellmap.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
OURS = packing.WordTokenizer(PATH, RANKS)
SLOW = packing.WordTokenizer(PATH)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(" \n\t\r\x0b 　ab'sé1,.ñ<|>"), max_size=30))
def test_word_cache_gives_the_tokenizers_ids(text):
    assert OURS.ids(text).tolist() == plain(text)
    assert SLOW.ids(text).tolist() == plain(text)


def test_texts_of_the_table_and_special_names(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect()]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "x" * 100_000, "é\u2009ü  z", "1 \xa0 \xa0", "a\n \nb", "a\t \t", "\ud7ff\U0001f600 it's 'S 12a"]
    for text in texts:
        assert OURS.ids(text).tolist() == plain(text)


def check(rows, pieces, length=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    padding = 0
    assert set(by_doc) == {r[0] for r in rows}
    for doc_id, text in rows:
        ids, at = [*plain(text), 0], 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            part = np.array(ids[at : at + p.length], "<u4")
            assert p.ids_crc32 == zlib.crc32(part.tobytes())
            at += p.length
        assert at == len(ids)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


def test_round_trip(spark):
    rng = np.random.default_rng(3)
    rows = [(0, None), (1, ""), (2, " "), (3, "word " * 5000), (4, "x" * 20_000)]
    rows += [(i, " ".join(f"w{n}" for n in rng.integers(0, 99, rng.integers(1, 900)))) for i in range(5, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = packing.pack(docs, PATH, group_docs=64, ranks=RANKS).collect()
    total = sum(p.length for p in pieces)
    assert check(rows, pieces) < 0.02 * total


def test_edge_rows(spark):
    schema = "start long, doc_id long, text string, bin string"
    assert packing.pack(spark.createDataFrame([], schema), PATH).collect() == []
    rows = [(1, 4, "same text", "x")] * 3 + [(None, None, None, None)]
    got = packing.pack(spark.createDataFrame(rows, schema), PATH).collect()
    sizes = sorted((p.doc_id or 0, p.doc_tokens) for p in {(p.sequence_id, p.offset): p for p in got}.values() if p.start == 0)
    assert sizes == [(0, 1), (4, 3), (4, 3), (4, 3)]


@pytest.mark.parametrize("capacity", [8, 100])
def test_first_fit_decreasing(capacity):
    rng = np.random.default_rng(capacity)
    sizes = rng.integers(1, capacity + 1, 300)
    got = packing.first_fit_decreasing(sizes, capacity)
    room = [capacity] * 300
    for item in np.argsort(-sizes, kind="stable"):
        want = next(b for b, r in enumerate(room) if r >= sizes[item])
        room[want] -= sizes[item]
        assert got[item] == want


def test_equal_rows_are_dealt_apart(spark):
    rows = spark.range(6000).selectExpr("CAST(NULL AS long) AS doc_id", "'the same words' AS text")
    docs = rows.repartition(4).unionByName(spark.createDataFrame([(1, "other"), (2, None)], "doc_id long, text string"))
    pieces = packing.pack(docs, PATH, group_docs=256, ranks=RANKS).collect()
    per_group = defaultdict(int)
    for p in pieces:
        per_group[p.sequence_id >> 32] += p.doc_id is None and p.start == 0
    assert sum(per_group.values()) == 6000 and max(per_group.values()) < 600
    assert {p.doc_id for p in pieces} == {None, 1, 2}
