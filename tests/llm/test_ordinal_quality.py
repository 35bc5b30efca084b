import numpy as np
import pyarrow as pa

from dwellmap.llm import ordinal_quality as quality

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ratings = quality.graded(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    learned = ratings.where("crc32(cast(doc_id as string)) % 4 <> 2")
    held = ratings.where("crc32(cast(doc_id as string)) % 4 = 2")
    model = quality.train(docs, learned)
    assert (np.diff(model.thresholds) > 0).all()
    rows = quality.grade(docs.join(held, "doc_id"), model).collect()
    keep = np.array([r.keep for r in rows])
    grade = np.array([r.grade for r in rows])
    expected = np.array([r.expected_grade for r in rows])
    assert keep[grade == 2].mean() > 0.97
    assert keep[grade < 2].mean() < 0.4
    assert expected[grade == 2].mean() > expected[grade == 1].mean() > expected[grade == 0].mean()


def test_gradient_fits_ordered_grades():
    rng = np.random.default_rng(0)
    strength = rng.normal(size=600)
    grades = np.digitize(strength, [-1, 0.3, 1])
    rows = [(np.array([0, 1]), np.array([s, 1], np.float32)) for s in strength]
    model = quality.fit(rows, grades)
    scores = np.array([v @ model.weights[p] for p, v in rows])
    got = (model.tails(scores) >= 0.5).sum(axis=1)
    assert (got == grades).mean() > 0.95


def test_edge_rows(spark):
    schema = "doc_id long, text string, keep string, grade string"
    docs = spark.createDataFrame(
        [(i, "good fine text" if i % 2 else "!!! @@ JUNK", "k", "g") for i in range(80)], schema
    )
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(80)] * 2 + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    model = quality.train(docs.drop("grade"), quality.graded(labels))
    odd = [(1, None, "k", "g"), (2, "", "k", None), (None, "good fine text", None, "g")] * 2
    odd += [(4, "good " * 300_000, "k", "g")]
    got = quality.grade(spark.createDataFrame(odd, schema), model).collect()
    assert len(got) == 7 and got[0].grade == "g"
    assert {(r.doc_id, r.keep) for r in got if r.doc_id != 4} == {(1, False), (2, False), (None, True)}
    empty = spark.createDataFrame([], schema)
    assert quality.grade(empty, model).collect() == []
    none = quality.train(empty.drop("grade"), quality.graded(labels))
    assert quality.grade(docs, none).count() == 80
    first, again = list(quality.features(pa.array(["a b", "a b"])))
    assert (first[0] == again[0]).all()
