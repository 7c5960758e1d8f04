"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features. A text is lower-cased, every run of characters other than letters becomes one space, and
its n-grams of one to three characters are hashed into ``BUCKETS``. A text's value in a bucket is the
share of its n-grams there, by the root of it to temper frequent ones, times the bucket's inverse
document frequency, divided by the length of the vector. Document frequencies are counted over all
texts that may be learned from: one array for each task, summed by bucket.

Training. Follow the regularised leader, with a learning rate for each weight and the penalties
``L1`` and ``L2``: a weight stays zero until its gradients agree on it. It runs in one task on a sample
of at most ``SAMPLE`` rows, an equal number for each language as far as there are so many, chosen by
hash. Every fifth row of the sample is kept out to fit the temperature: the number by which scores are
divided so that their probabilities are most likely on rows not trained on.

The model is a matrix of buckets times languages, whose size does not depend on the data, so it is sent to all
tasks. Prediction runs on whole texts, row by row, without a shuffle.

Cases: a null text, or one without a letter, is ``und`` with score 0. Rows without a language or an id
are not learned from. A language is known only if the sample holds it; with none, everything is
``und``. Repeated rows are predicted alike. Columns other than those named are not carried.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, map_batches, prepare

BUCKETS = 1 << 15
#: Most rows of the training sample.
SAMPLE = 6000
#: Learning rate, its offset, penalties, and passes over the sample.
RATE, OFFSET, L1, L2, PASSES = 0.5, 1.0, 0.01, 0.001, 3
UNKNOWN = "und"

_KEYS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@functools.cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.frombuffer(bytes(unicodedata.category(chr(i))[0] == "L" for i in range(sys.maxunicode + 1)), bool)


def counts(text: str | None) -> np.ndarray | None:
    """The n-grams by bucket; None for a text without letters."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return None
    # One space before, between and after words.
    points = np.where(letter, points, np.uint32(32))
    points = points[letter | np.append(True, letter[:-1])]
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]]).astype(np.uint32)
    points = points[~((points == 32) & np.append(False, points[:-1] == 32))]
    total = np.zeros(BUCKETS, np.int64)
    gram = np.zeros(len(points), np.uint32)
    for n in range(min(3, len(points))):
        gram = (gram[: len(points) - n] + points[n:]) * _KEYS[n]
        spread = gram ^ (gram >> np.uint32(15))
        total += np.bincount((spread * np.uint32(0x27D4EB2F)) >> np.uint32(17), minlength=BUCKETS)
    return total


def values(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that are not empty, and the vector's values there."""
    at = np.flatnonzero(found)
    value = np.sqrt(found[at] / found.sum()) * idf[at]
    length = np.sqrt(value @ value)
    return at, value / length if length else value


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """By bucket the texts that hold it, and the texts with letters. ``texts`` has the column text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(None, lambda: None)
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if (found := counts(text)) is not None:
                    total += found > 0
                    n += 1
        if n:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], n))], names=["bucket", "n"])

    sums = texts.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in sums:
        if bucket >= 0:
            out[bucket] = n
    return out, next((n for bucket, n in sums if bucket < 0), 0)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Weights of buckets by class. A row: buckets, values, class."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        step = (OFFSET + np.sqrt(n[at])) / RATE + L2
        return np.where(np.abs(own) <= L1, 0.0, (np.sign(own) * L1 - own) / step)

    for _ in range(PASSES):
        for at, value, label in rows:
            w = weights(at)
            gradient = probabilities(value @ w, 1.0)
            gradient[label] -= 1
            g = value[:, None] * gradient
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / RATE
            z[at] += g - rate * w
            n[at] += g * g
    return weights(np.arange(BUCKETS))


def probabilities(scores: np.ndarray, temperature: float) -> np.ndarray:
    scores = (scores - scores.max(-1, keepdims=True)) / temperature
    e = np.exp(scores)
    return e / e.sum(-1, keepdims=True)


def calibrated(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that makes the labels most likely, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = probabilities(scores, np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean()

    low, high, golden = np.log(0.1), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


class Model:
    def __init__(self, idf: np.ndarray, weights: np.ndarray, languages: list[str], temperature: float):
        self.idf, self.weights, self.languages, self.temperature = idf, weights, languages, temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        found = counts(text)
        if found is None or not self.languages:
            return UNKNOWN, 0.0
        at, value = values(found, self.idf)
        p = probabilities(value @ self.weights[at], self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit(examples: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the columns id (not null), text and lang. ``sample`` bounds the rows that are trained on."""
    spark = examples.sparkSession
    prepare(spark)
    labelled = examples.filter("text IS NOT NULL AND lang IS NOT NULL AND id IS NOT NULL")
    frequency, n = document_frequencies(labelled.select("text"))
    idf = np.log((1 + n) / (1 + frequency)) + 1
    # One row for each language.
    per_language = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(per_language)
    if not languages:
        return Model(idf, np.zeros((BUCKETS, 0)), [], 1.0)
    quota = max(1, sample // len(languages))
    rank = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    # A tenth more than the quota by hash; the training task takes the quota.
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in per_language.items() for x in (k, min(1.0, 1.1 * quota / n) * (1 << 30))]), F.col("lang"))
    # Rows alike in id, text and language count once, so no repeated row can fill the training task.
    chosen = labelled.filter(rank < share).dropDuplicates(["lang", "id", "text"]).select("lang", rank.alias("rank"), "text")

    def featured(batch: pa.RecordBatch) -> dict:
        found = [counts(t) for t in batch.column(2).to_pylist()]
        pairs = [values(f, idf) if f is not None else (np.empty(0, np.int64), np.empty(0)) for f in found]
        return {
            "lang": batch.column(0), "rank": batch.column(1),
            "at": pa.array([a.astype(np.int32) for a, _ in pairs], pa.list_(pa.int32())),
            "value": pa.array([v.astype(np.float32) for _, v in pairs], pa.list_(pa.float32())),
        }

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows["at"].map(len) > 0].sort_values(["rank", "lang"])
        rows = rows[rows.groupby("lang").cumcount() < quota].sort_values(["rank", "lang"])
        labels = rows["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy()
        vectors = [(np.asarray(a), np.asarray(v, float), int(y)) for a, v, y in zip(rows["at"], rows["value"], labels)]
        kept_out = np.arange(len(vectors)) % 5 == 4
        weights = follow_the_leader([v for v, out in zip(vectors, kept_out) if not out], len(languages))
        scores = np.array([v @ weights[a] for (a, v, _), out in zip(vectors, kept_out) if out]).reshape(-1, len(languages))
        temperature = calibrated(scores, labels[kept_out])
        at, language = np.nonzero(weights)
        out = pd.DataFrame({"bucket": at, "language": language, "weight": weights[at, language]})
        return pd.concat([out, pd.DataFrame({"bucket": [-1], "language": [-1], "weight": [temperature]})])

    sampled = map_batches(chosen, featured, "lang string, rank bigint, at array<int>, value array<float>")
    learned = sampled.withColumn("_all", F.lit(True)).groupBy("_all").applyInPandas(train, "bucket int, language int, weight double").collect()
    weights, temperature = np.zeros((BUCKETS, len(languages))), 1.0
    for bucket, language, weight in learned:
        if bucket < 0:
            temperature = weight
        else:
            weights[bucket, language] = weight
    return Model(idf, weights, languages, temperature)


def predict(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows with lang_pred and score (the calibrated probability, 0 to 1); columns of these names are replaced."""
    prepare(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sent.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    others = [F.col(f"`{c}`") for c in documents.columns if c not in ("lang_pred", "score")]
    told = documents.select(*others, predicted(F.col(f"`{text}`").cast("string")).alias("_told"))
    return told.select(*others, "_told.lang_pred", "_told.score")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for testing: a quarter, by the checksum of its id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learnable(documents: DataFrame) -> DataFrame:
    """id, text and lang of the rows that may be learned from."""
    return documents.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), "text", "lang")
