"""Token files: what is read back is what the tokenizer gives, document by document."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dwellmap.llm.queries import op12_token_files
from dwellmap.llm.token_files import TokenFiles, WordwiseTokenizer, is_wordwise, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def wordwise():
    return WordwiseTokenizer(PATH, 2)


LETTERS = "HhJjSsTtWwYyİ̱̌̇̈̊?!;:aAbéÉ \t\n\x0b\x0c\x1c\x1f\x85\xa0'’stm12.,-́ͅẞ　​ßİiΣσς你好🙂ſﬁ\x00"


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.one_of(st.text(LETTERS, max_size=12), st.sampled_from(["<|endoftext|>", "<|EndOfText|>", "Word,", "Éa?!", "ǅ.", "ɐ."]), st.text(max_size=6)), max_size=6))
def test_word_by_word_is_the_tokenizer(whole, wordwise, parts):
    for text in (" ".join(parts), "".join(parts)):
        ids = np.frombuffer(wordwise.encode(text), "<u2").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids


def test_only_for_tokenizers_that_drop_white_space(whole):
    assert is_wordwise(whole) and not is_wordwise(Tokenizer.from_file(BYTES))


def table(rows, encode, end_id):
    """(id, start, tokens, checksum) of rows given in file order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_is_an_exact_round_trip(spark, whole):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in op12_token_files(spark, folder).orderBy("doc_id").collect()]
    assert got == table(sorted(docs), whole.encode, 2)


def test_shards_join_to_one_sequence(spark, whole, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    files = write_token_files(docs, str(tmp_path / "t"), PATH, 2, shard_bytes=1 << 15)
    rows = sorted(docs.select("doc_id", "text").collect())
    sequence = [i for _, t in rows for i in [*whole.encode(t or "", add_special_tokens=False).ids, 2]]
    manifest = files.manifest.orderBy("shard").collect()
    assert len(manifest) > 5
    assert [m.base for m in manifest] == np.cumsum([0, *(m.n_tokens for m in manifest)])[:-1].tolist()
    assert files.tokens(0, len(sequence) + 9).tolist() == sequence
    assert files.tokens(4000, 30_000).tolist() == sequence[4000:34_000]
    # The files are flat: numpy alone reads them.
    flat = [np.fromfile(tmp_path / "t" / f"{m.name}.ids", "<u2") for m in manifest]
    assert np.concatenate(flat).tolist() == sequence
    places = np.fromfile(tmp_path / "t" / f"{manifest[0].name}.offsets", "<u8")
    assert len(places) == manifest[0].n_docs + 1 and places[-1] == manifest[0].n_tokens
    again = TokenFiles.open(spark, str(tmp_path / "t")).documents(with_ids=True)
    assert [i for r in again.orderBy("start").collect() for i in r.ids] == sequence


def test_odd_rows_and_wide_ids(spark, tmp_path):
    rows = [(5, "b a", 1), (None, "x", 2), (3, None, 3), (3, "", 4), (5, "b a", 5), (4, "many words " * 50_000, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(3)
    end = 70_000
    files = write_token_files(docs, str(tmp_path / "t"), BYTES, end, shard_bytes=1 << 18)
    assert {m.width for m in files.manifest.collect()} == {4}
    got = [tuple(r) for r in files.documents().orderBy("start").collect()]
    encode = Tokenizer.from_file(BYTES).encode
    assert got == table([(None, "x"), (3, ""), (3, ""), (4, rows[5][1]), (5, "b a"), (5, "b a")], encode, end)
    with pytest.raises(ValueError, match="not empty"):
        write_token_files(docs, str(tmp_path / "t"), BYTES, end)
    none = write_token_files(docs.limit(0), str(tmp_path / "none"), PATH, 2)
    assert none.documents().collect() == [] and none.tokens(0, 5).tolist() == []


def test_rows_of_one_id_are_split_and_left_files_ignored(spark, tmp_path):
    docs = spark.range(4000).selectExpr("'k' AS doc_id", "'the same few words' AS text")
    files = write_token_files(docs.repartition(4), str(tmp_path / "t"), PATH, 2, shard_bytes=8000)
    sizes = [m.n_docs for m in files.manifest.collect()]
    assert len(sizes) > 5 and max(sizes) < 1500 and sum(sizes) == 4000
    name = files.manifest.first().name
    (tmp_path / "t" / "shard-000000-lost.ids").write_bytes(b"\0" * 99)
    assert files.documents().count() == 4000
    os.truncate(tmp_path / "t" / f"{name}.ids", 4)
    with pytest.raises(Exception, match="not as long as the manifest"):
        files.documents().collect()


def test_new_words_of_letters_are_encoded_as_one_text(whole, monkeypatch):
    wordwise, calls = WordwiseTokenizer(PATH, 2), []
    one_by_one = wordwise._ids
    monkeypatch.setattr(wordwise, "_ids", lambda texts: calls.extend(texts) or one_by_one(texts))
    # A capital I with a dot becomes two parts, so the words beside it are encoded one by one.
    for text, alone in (("etépaierai, undch zzqx Éleè!", {",", "!"}), ("ouenchtre xİa qqzzv", {"ouenchtre", "xİa", "qqzzv"})):
        calls.clear()
        ids = np.frombuffer(wordwise.encode(text), "<u2").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids
        assert set(calls) == alone
