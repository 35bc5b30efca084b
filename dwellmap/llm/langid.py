"""Language identification with error-correcting output codes.

Every language has a codeword of bits. A binary classifier per bit, a logistic regression on hashed
byte n-grams, predicts it; decoding takes the codeword with the least loss, weighted by how reliable
each bit proved in training, and flags texts for which a second codeword comes close.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellmap.llm.texthash import chunks
from dwellmap.session import prepare

UNKNOWN = "und"
_BIGRAMS, _TRIGRAMS = 1024, 2048
FEATURES = 256 + _BIGRAMS + _TRIGRAMS
_ROWS = 256


def _letters_only() -> np.ndarray:
    """ASCII bytes that are no letters become spaces; bytes of other characters stay."""
    table = np.arange(256, dtype=np.uint8)
    for b in range(128):
        if not chr(b).isalpha():
            table[b] = 0x20
    return table


_LETTERS = _letters_only()


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Blocks of rows: square roots of the counts of hashed 1- to 3-grams of bytes, of length 1.

    Texts are taken whole and should be lower-cased.
    """
    # The n-grams of spaces only say nothing.
    blank = [0x20, 256 + _hash2(0x20, 0x20), 256 + _BIGRAMS + _hash3(0x20, 0x20, 0x20)]
    for first, last, data, bounds in chunks(texts):
        b = _LETTERS[data].astype(np.uint32)
        two = 256 + _hash2(b[:-1], b[1:])
        three = 256 + _BIGRAMS + _hash3(b[:-2], b[1:-1], b[2:])
        for start in range(0, last - first, _ROWS):
            rows = range(start, min(start + _ROWS, last - first))
            block = np.zeros((len(rows), FEATURES), np.float32)
            for out, row in zip(block, rows, strict=True):
                lo, hi = bounds[row], bounds[row + 1]
                if hi > lo:
                    out += np.bincount(b[lo:hi], minlength=FEATURES)
                    out += np.bincount(two[lo : max(lo, hi - 1)], minlength=FEATURES)
                    out += np.bincount(three[lo : max(lo, hi - 2)], minlength=FEATURES)
            block[:, blank] = 0
            np.sqrt(block, out=block)
            block /= np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-9)
            yield block


def _hash2(a, b):
    return ((a * 0x9E3779B1 + b * 0x85EBCA77) & 0xFFFFFFFF) >> 22 if isinstance(a, int) else (
        (a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77)) >> np.uint32(22)
    )


def _hash3(a, b, c):
    if isinstance(a, int):
        return ((a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0xFFFFFFFF) >> 21
    return (
        a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)
    ) >> np.uint32(21)


def codewords(count: int) -> np.ndarray:
    """A code of +1 and -1 for ``count`` classes: all ways to split up to six classes in two, else
    the random code whose closest codewords are furthest apart."""
    if count < 2:
        return np.ones((count, 0), np.float32)
    if count <= 6:
        columns = [c for c in itertools.product([1, -1], repeat=count - 1) if -1 in c]
        return np.array([(1, *c) for c in columns], np.float32).T
    bits, rng = 15 * (count - 1).bit_length(), np.random.default_rng(count)
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.float32), (count, bits))
        if (np.abs(code.sum(axis=0)) == count).any():
            continue
        distance = (bits - code @ code.T) / 2
        closest = distance[~np.eye(count, dtype=bool)].min()
        if closest > apart:
            best, apart = code, closest
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    reliability: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its share, and its lead over the second, for rows of features."""
        margins = x @ self.weights + self.bias
        losses = np.stack(
            [(np.logaddexp(0, -margins * word) * self.reliability).sum(axis=1) for word in self.code],
            axis=1,
        )
        share = np.exp(losses.min(axis=1, keepdims=True) - losses)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        ranked = np.sort(share, axis=1)
        lead = ranked[:, -1] - (ranked[:, -2] if ranked.shape[1] > 1 else 0)
        return best, ranked[:, -1], lead


def fit(x: np.ndarray, languages: list[str], y: np.ndarray, steps: int = 120) -> Model:
    """Logistic regressions for all bits at once, by full-batch Adam with classes weighted alike."""
    code = codewords(len(languages))
    bits = code.shape[1]
    weights, bias = np.zeros((x.shape[1], bits), np.float32), np.zeros(bits, np.float32)
    target = code[y]
    share = 1 / np.bincount(y, minlength=len(languages))[y]
    share = (share / share.sum()).astype(np.float32)[:, None]
    m = [np.zeros_like(weights), np.zeros_like(bias)]
    v = [np.zeros_like(weights), np.zeros_like(bias)]
    for step in range(1, steps + 1):
        margins = x @ weights + bias
        pull = -target / (1 + np.exp(target * margins)) * share
        for part, grad, m_, v_ in zip(
            (weights, bias), (x.T @ pull + 1e-5 * weights, pull.sum(axis=0)), m, v, strict=True
        ):
            m_ += 0.1 * (grad - m_)
            v_ += 0.01 * (grad * grad - v_)
            part -= 0.3 * (m_ / (1 - 0.9**step)) / (np.sqrt(v_ / (1 - 0.99**step)) + 1e-8)
    right = ((x @ weights + bias) * target > 0).mean(axis=0) if len(x) else np.ones(bits)
    reliability = np.clip(2 * right - 1, 0.01, 1)
    return Model(languages, code, weights, bias, reliability.astype(np.float32))


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def train(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    sample_per_language: int = 500,
    sample_texts: int = 50_000,
) -> Model:
    """Learn every language found from a bounded sample: at most ``sample_per_language`` distinct labelled
    texts of each, taken by the order of a hash; fewer where so many would be more than ``sample_texts``
    in all, but never none.

    The features of the sample, 13 KB a text whatever its length, go to one task, which fits the model; the driver
    gets limits and weights only.
    """
    prepare(labelled.sparkSession)
    usable = labelled.where(F.col(lang).isNotNull() & has_letter(text)).select(
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
    )
    found = usable.select("lang").distinct().count()
    most = max(1, min(sample_per_language, sample_texts // max(found, 1)))
    keyed = usable.withColumn("h", F.xxhash64("text"))
    # Hashes fall into 32 bands an octave; bands are taken from the lowest while the sample has room.
    share = F.shiftrightunsigned("h", 1).cast("double") / F.lit(2.0**63) + F.lit(2.0**-63)
    band = F.floor(F.log2(share) * 32).cast("int")
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("band"))
    limits = (
        keyed.groupBy("lang", "h")
        .agg(F.count("*").alias("copies"))
        .groupBy("lang", band.alias("band"))
        .agg(F.count("*").alias("n"))
        .withColumn("upto", upto)
        .groupBy("lang")
        # The lowest band, of about one text, is always taken.
        .agg(F.coalesce(F.max(F.when(F.col("upto") <= most, F.col("band"))), F.min("band")).alias("limit"))
        .collect()
    )
    languages = sorted(r["lang"] for r in limits)
    if not languages:
        return fit(np.zeros((0, FEATURES), np.float32), [], np.zeros(0, int))
    limit = F.create_map(*[F.lit(v) for r in limits for v in (r["lang"], r["limit"])])
    chosen = keyed.where(band <= limit[F.col("lang")]).dropDuplicates(["lang", "h"])

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row.tobytes() for block in features(batch.column(2)) for row in block]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["lang", "h", "x"]
            )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows = [], []
        for batch in batches:
            if not len(batch):
                continue
            names += batch.column(0).to_pylist()
            rows.append(np.stack([np.frombuffer(v, np.float32) for v in batch.column(2).to_pylist()]))
        if names:
            model = fit(np.concatenate(rows), languages, np.searchsorted(languages, names))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    described_sample = chosen.select("lang", "h", F.lower("text").alias("text")).mapInArrow(
        described, "lang string, h long, x binary"
    )
    # In the order of language and hash, so that the model doesn't depend on how the rows are dealt out.
    ordered = described_sample.repartition(1).sortWithinPartitions("lang", "h")
    return pickle.loads(ordered.mapInArrow(fitted, "model binary").first()["model"])


def identify(
    docs: DataFrame, model: Model, text: str = "text", min_lead: float = 0.1
) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``ambiguous`` to the documents.

    ``score`` is the winner's share of exp(-loss) over all codewords. ``ambiguous`` marks a lead of
    less than ``min_lead`` over the second. Null texts and texts without a letter are ``und`` with
    score 0, and so is everything if no language was learned. Columns with these names are replaced.
    ``text`` may be a field of a struct column.
    """

    prepare(docs.sparkSession)

    @F.arrow_udf("struct<best int, score double, lead double>")
    def judge(texts: pa.Array) -> pa.Array:
        parts = [model.decode(block) for block in features(texts)]
        best, score, lead = (
            (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else ([], [], [])
        )
        return pa.StructArray.from_arrays(
            [
                pa.array(best, pa.int32()),
                pa.array(np.clip(score, 0, 1), pa.float64()),
                pa.array(lead, pa.float64()),
            ],
            ["best", "score", "lead"],
        )

    names = {"lang_pred", "score", "ambiguous"}
    kept = [c for c in docs.columns if c not in names]
    if not model.languages:
        return docs.select(
            *kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous")
        )
    known = F.array(*[F.lit(name) for name in model.languages])
    judged = docs.select(
        *kept,
        has_letter(text).alias("__letter"),
        judge(F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("__judged"),
    )
    return judged.select(
        *kept,
        F.when(F.col("__letter"), F.get(known, F.col("__judged.best"))).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("__letter"), F.col("__judged.score")).otherwise(0.0).alias("score"),
        (~F.col("__letter") | (F.col("__judged.lead") < min_lead)).alias("ambiguous"),
    )


def held_out(id_column: str = "doc_id") -> Column:
    """Documents never learned from: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))
