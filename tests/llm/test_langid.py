import zlib

import numpy as np
import pyarrow as pa

from dwellmap.llm import langid
from dwellmap.llm.queries import op7_language_id

SF_DIR = "/root/testdata/sf0.01"


def test_codewords_are_far_apart():
    for count in (2, 3, 4, 6, 7, 12):
        code = langid.codewords(count)
        distance = (code.shape[1] - code @ code.T) / 2
        assert distance[~np.eye(count, dtype=bool)].min() >= max(1, code.shape[1] // 4)
        assert (np.abs(code.sum(axis=0)) < count).all()
    assert langid.codewords(1).shape == (1, 0) and langid.codewords(0).shape == (0, 0)


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op7_language_id(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(truth) and len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.ambiguous for r in rows]) < 0.01


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, score string, best string"
    rows = [(1, "der die das und nicht", "de", "s", "b"), (2, "the and of to in", "en", None, None)] * 3
    docs = spark.createDataFrame(rows, schema)
    model = langid.train(docs)
    odd = [(3, None, None, "s", "b"), (4, "", None, "s", "b"), (5, "12 -- 3!", None, "s", "b")]
    odd += [(None, "the " * 200_000, None, "s", None), (6, "DER UND", None, None, None)] * 2
    got = langid.identify(spark.createDataFrame(odd, schema), model).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [
        (0, "en"), (0, "en"), (3, "und"), (4, "und"), (5, "und"), (6, "de"), (6, "de")
    ]
    assert all(r.score == 0 and r.ambiguous for r in got if r.lang_pred == "und")
    assert got[0].best == "b"
    empty = spark.createDataFrame([], schema)
    assert langid.identify(empty, model).collect() == []
    blind = langid.identify(docs, langid.train(empty)).collect()
    assert {(r.lang_pred, r.score) for r in blind} == {("und", 0.0)}
    single = langid.identify(docs, langid.train(docs.where("lang = 'de'"))).collect()
    assert {(r.lang_pred, r.score) for r in single} == {("de", 1.0)}


def test_every_language_is_learned(spark):
    words = {f"l{i:03}": "".join(chr(97 + (i * k + k * k) % 26) for k in range(1, 13)) for i in range(130)}
    rows = [(i * 10 + j, f"{w} {w} {j * '.'}", lang) for i, (lang, w) in enumerate(words.items()) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.train(docs).languages == sorted(words)
    model = langid.train(docs, sample_texts=2)
    assert model.languages == sorted(words)


def test_features_do_not_depend_on_neighbours():
    texts = ["abc def", None, "ü", "x" * 3_000_000, "abc def"]
    rows = np.concatenate(list(langid.features(pa.array(texts))))
    assert len(rows) == 5 and (rows[0] == rows[4]).all() and not rows[1].any()
    alone = np.concatenate(list(langid.features(pa.array(["abc def"]))))
    assert np.allclose(rows[0], alone[0])


def test_the_sample_stays_off_the_driver(spark, monkeypatch):
    rows = [(i, f"{word} {word} {'x' * i}", lang) for i in range(40) for lang, word in (("de", "und"), ("en", "the"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def fail(*_, **__):
        raise AssertionError("features came to the driver")

    monkeypatch.setattr(langid.np, "stack", fail)
    monkeypatch.setattr(type(docs), "toArrow", fail)
    one, other = langid.train(docs), langid.train(docs.repartition(7))
    assert one.languages == ["de", "en"]
    assert (one.weights == other.weights).all() and (one.bias == other.bias).all()
