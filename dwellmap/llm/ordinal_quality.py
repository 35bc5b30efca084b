"""Quality of texts on an ordered scale: a cumulative-link regression on hashed text.

One vector of weights over hashed words is shared by all grades; ordered thresholds on its score give
the probability of each grade or better, and from these the expected grade and the tail probability
used for selection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmap.llm.sampling import hash_sample, hash_share
from dwellmap.llm.texthash import chunks, words

_WORDS = 1 << 18
_LEVELS = 8
_LEAST_TEXTS = 10
_STYLES = 5
FEATURES = _WORDS + _STYLES * _LEVELS


def _kinds() -> np.ndarray:
    """Per byte: capital letter, digit, other ASCII sign, first byte of a character."""
    table = np.zeros((256, 4), np.int64)
    for b in range(128):
        c = chr(b)
        table[b] = (c.isupper(), c.isdigit(), not (c.isalnum() or c.isspace()), True)
    table[0xC0:, 3] = 1
    return table


_KINDS = _kinds()
#: Words here are runs of ASCII letters and digits and of any other characters beyond ASCII.
_SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each whole text, feature numbers and values.

    A word's value is the square root of its share. Five properties of style, cut into eight levels
    each, are features too: capitals, digits, signs, word length, and how few words are distinct.
    """
    for first, last, data, bounds in chunks(texts):
        with np.errstate(over="ignore"):
            hashes, at = words(data, bounds, _SIGNS)
        places = (hashes % np.uint64(_WORDS)).astype(np.int64)
        sums = np.stack([np.concatenate(([0], np.cumsum(_KINDS[data, k]))) for k in range(4)], 1)
        for row in range(last - first):
            n = at[row + 1] - at[row]
            if not n:
                yield np.zeros(0, np.int64), np.zeros(0, np.float32)
                continue
            found, counts = np.unique(places[at[row] : at[row + 1]], return_counts=True)
            capital, digit, sign, chars = sums[bounds[row + 1]] - sums[bounds[row]]
            style = np.array([capital / chars, digit / chars, sign / chars, chars / n / 40, len(found) / n])
            level = np.minimum((np.sqrt(style) * _LEVELS).astype(np.int64), _LEVELS - 1)
            styles = _WORDS + np.arange(_STYLES) * _LEVELS + level
            yield (
                np.concatenate([found, styles]),
                np.concatenate([np.sqrt(counts / n), np.full(_STYLES, 0.3)]).astype(np.float32),
            )


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; grade k or better lies above thresholds[k - 1]

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... in columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - scores[:, None], -50, 50)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, steps: int = 250) -> Model:
    """Maximum likelihood with a small ridge, by full-batch Adam.

    Thresholds are the first one and the logarithms of the gaps, so they stay ordered. Words found in
    fewer than ``_LEAST_TEXTS`` texts keep the weight 0.
    """
    top = int(grades.max()) if len(grades) else 1
    weights, raw = np.zeros(FEATURES), np.zeros(max(top, 1))
    if not len(grades):
        return Model(weights, raw)
    places = np.concatenate([r[0] for r in rows])
    values = np.concatenate([r[1] for r in rows]).astype(np.float64)
    values *= (np.bincount(places, minlength=FEATURES) >= _LEAST_TEXTS)[places]
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    state = [np.zeros(FEATURES + len(raw)) for _ in range(2)]
    for step in range(1, steps + 1):
        scores = np.bincount(owner, weights=values * weights[places], minlength=len(rows))
        gaps = np.exp(raw[1:])
        model = Model(weights, raw[0] + np.concatenate([[0], np.cumsum(gaps)]))
        p = model.tails(scores)
        padded = np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1)
        mass = padded[np.arange(len(p)), grades] - padded[np.arange(len(p)), grades + 1]
        # d log-likelihood / d tail: + for the tail that opens the grade, - for the one that ends it.
        slope = np.zeros_like(p)
        opens, ends = grades > 0, grades < top
        slope[opens, grades[opens] - 1] = 1
        slope[ends, grades[ends]] = -1
        slope = slope * p * (1 - p) / np.maximum(mass, 1e-9)[:, None]
        pull = slope.sum(axis=1) / len(p)
        d_weights = np.bincount(places, weights=values * pull[owner], minlength=FEATURES) - 1e-5 * weights
        d_level = -slope.mean(axis=0)
        d_raw = np.concatenate([[d_level.sum()], np.cumsum(d_level[::-1])[::-1][1:] * gaps])
        gradient = np.concatenate([d_weights, d_raw])
        state[0] += 0.1 * (gradient - state[0])
        state[1] += 0.01 * (gradient**2 - state[1])
        move = 0.3 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        weights, raw = weights + move[:FEATURES], raw + move[FEATURES:] * 0.3
    return Model(weights, raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))]))


def graded(labels: DataFrame) -> DataFrame:
    """Ratings from 0 to 2, one per document: a point for quality and one for not being toxic.

    Rows without a rating are left out; of several ratings of a document the lowest counts.
    """
    rated = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    return rated.groupBy("doc_id").agg(
        F.min(F.col("quality") + 1 - F.col("toxic")).cast("int").alias("grade")
    )


def train(
    docs: DataFrame, ratings: DataFrame, text: str = "text", max_sample: int = 8000
) -> Model:
    """Learn from at most ``max_sample`` rated documents, taken by the order of a hash of their ids.

    ``ratings`` has ``doc_id`` and ``grade`` (0, 1, ...). The sample's hash limit is a filter, so no
    other document's text moves. Only its features come to the driver: at most 2 MB a text whatever
    its length, and usually a few.
    """
    key = hash_share("doc_id")
    rated = hash_sample(ratings.select("doc_id"), ["doc_id"], max_sample)
    limit = rated.agg(F.max("h")).first()[0]
    if limit is None:
        return fit([], np.zeros(0, int))
    chosen = (
        docs.where(key <= limit)
        .select("doc_id", F.col(text).cast("string").alias("text"))
        .dropDuplicates(["doc_id"])
        .join(ratings.where(key <= limit), "doc_id")
    )

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(features(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([r[0].astype("<u4").tobytes() for r in rows], pa.binary()),
                    pa.array([r[1].tobytes() for r in rows], pa.binary()),
                ],
                ["h", "grade", "places", "values"],
            )

    sample = (
        chosen.select(key.alias("h"), "grade", "text")
        .mapInArrow(described, "h double, grade int, places binary, values binary")
        .toArrow()
        .sort_by("h")
    )
    rows = [
        (np.frombuffer(p, "<u4").astype(np.int64), np.frombuffer(v, np.float32))
        for p, v in zip(sample["places"].to_pylist(), sample["values"].to_pylist(), strict=True)
    ]
    return fit(rows, np.array(sample["grade"].to_pylist(), int))


def grade(
    docs: DataFrame, model: Model, text: str = "text", tail: int = 2, keep_from: float = 0.6
) -> DataFrame:
    """Add ``expected_grade``, ``tail_probability`` (of the grade ``tail`` or better) and ``keep``.

    Null and empty texts are scored as texts without any feature but are never kept. Existing columns
    with these names are replaced; rows are neither added nor lost.
    """
    tail = min(tail, len(model.thresholds))

    @F.arrow_udf("struct<expected double, tail double>")
    def judge(texts: pa.Array) -> pa.Array:
        scores = np.array([float(v @ model.weights[p]) for p, v in features(texts)])
        tails = model.tails(scores)
        return pa.StructArray.from_arrays(
            [pa.array(tails.sum(axis=1)), pa.array(tails[:, tail - 1])], ["expected", "tail"]
        )

    names = ("expected_grade", "tail_probability", "keep")
    kept = [c for c in docs.columns if c not in names]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    judged = docs.select(*kept, judge(whole).alias("__judged"), (whole != "").alias("__filled"))
    return judged.select(
        *kept,
        F.col("__judged.expected").alias("expected_grade"),
        F.col("__judged.tail").alias("tail_probability"),
        ((F.col("__judged.tail") >= keep_from) & F.col("__filled")).alias("keep"),
    )
