"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; runs of anything but letters become one space; n-grams of one to three characters hash
into ``DIMENSIONS`` features. Document frequencies come from every training document. Weights are fitted by
follow-the-regularised-leader with L1 and L2 penalties (FTRL-proximal) on at most about ``SAMPLE`` labelled
documents, an equal share per language, picked by a hash of doc_id; a temperature is then fitted on a part of
the sample that the weights did not see. The weights stay with the driver (``DIMENSIONS`` x languages).

Training documents are those with a non-null lang for which ``trainable`` holds. Scores are the calibrated
probability of the predicted language, over whole texts.

Defined cases. A null text, or one without a letter, is ``und`` with score 0. A null lang is never learned
from. A table without training documents predicts ``und`` with score 0 for every row. Repeated rows are
scored alike; ties between languages go to the first by code point. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideskein.llm.common import slices

DIMENSIONS = 1 << 15
SAMPLE = 4000
ORDERS = 3
_SEPARATORS = re.compile(r"[\W\d_]+")
_LETTER = re.compile(r"[^\W\d_]")


def ngrams(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Feature of every n-gram occurrence in the text, orders one after the other."""
    clean = " " + _SEPARATORS.sub(" ", text.lower()) + " "
    points = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out, rolling = [], np.zeros(len(points), dtype=np.uint32)
    for order in range(ORDERS):
        if order >= len(points):
            break
        rolling = (rolling[: len(points) - order] + points[order:] + np.uint32(order + 1)) * np.uint32(2654435761)
        rolling ^= rolling >> np.uint32(15)
        out.append(rolling % np.uint32(dimensions))
    return np.concatenate(out)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # DIMENSIONS x languages, IDF and temperature multiplied in
    bias: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not _LETTER.search(text):
            return "und", 0.0
        grams = ngrams(text, len(self.weights))
        logits = self.bias + self.weights[grams].mean(axis=0, dtype=np.float64)
        odds = np.exp(logits - logits.max())
        best = int(odds.argmax())
        return self.languages[best], float(odds[best] / odds.sum())


def document_frequencies(texts: DataFrame, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, int]:
    """Of all rows of ``texts``: in how many each feature occurs, and how many there are. Each task sends one count per feature."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(dimensions, dtype=np.int64), 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                seen = np.zeros(dimensions, dtype=bool)
                seen[ngrams(text, dimensions)] = True
                total += seen
                rows += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(total[at], rows), pa.int64())], names=["feature", "n"])

    counts = texts.select("text").where("text is not null").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    out, rows = np.zeros(dimensions, dtype=np.int64), 0
    for r in counts:
        if r.feature < 0:
            rows = r.n
        else:
            out[r.feature] = r.n
    return out, rows


def _rows_of_features(texts: DataFrame, dimensions: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, features, term frequencies) of a bounded sample, in a fixed order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, tf = [], []
            for text in batch.column(1).to_pylist():
                grams = ngrams(text, dimensions)
                features, n = np.unique(grams, return_counts=True)
                at.append(features.astype(np.int32))
                tf.append((n / len(grams)).astype(np.float32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(at, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.float32()))], names=["lang", "rank", "at", "tf"])

    rows = texts.select("lang", "text", "rank").mapInArrow(run, "lang string, rank long, at array<int>, tf array<float>").toArrow()
    order = np.argsort(rows["rank"].to_numpy(), kind="stable")
    langs, at, tf = rows["lang"].to_pylist(), rows["at"].combine_chunks(), rows["tf"].combine_chunks()
    return [(langs[i], at[int(i)].values.to_numpy(), tf[int(i)].values.to_numpy()) for i in order]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], dimensions: int, classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """FTRL-proximal weights (dimensions + 1 bias row) x classes under elastic-net penalties."""
    z, n = np.zeros((dimensions + 1, classes)), np.zeros((dimensions + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            label, features, values = rows[i]
            at, x = np.append(features, dimensions), np.append(values, 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[label] -= 1.0
            gradient = x[:, None] * error[None, :]
            sigma = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / alpha
            z[at] += gradient - sigma * w
            n[at] += gradient**2
    return weights(np.arange(dimensions + 1))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, g = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, trainable: Column, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> Model:
    """Learn from the text and lang of the rows of ``docs`` for which ``trainable`` holds."""
    known = docs.where(trainable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((dimensions, 0)), np.zeros(0))
    frequency, n_docs = document_frequencies(known, dimensions)
    idf = np.log((1.0 + n_docs) / (1.0 + frequency)) + 1.0
    rank = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    share = F.create_map(*(F.lit(x) for lang in languages for x in (lang, int((1 << 30) * min(1.0, sample / len(languages) / counts[lang])))))
    rows = _rows_of_features(known.withColumn("rank", rank).where(F.col("rank") < share[F.col("lang")]), dimensions)
    place = {lang: i for i, lang in enumerate(languages)}
    scaled = []
    for lang, at, tf in rows:
        x = tf * idf[at]
        scaled.append((place[lang], at, x))
    checks = scaled[::5] if len(scaled) >= 50 else []
    learned = [r for i, r in enumerate(scaled) if i % 5] if checks else scaled
    w = ftrl([(label, at, x * 20.0) for label, at, x in learned], dimensions, len(languages))
    logits = np.array([w[-1] + (x * 20.0) @ w[at] for _, at, x in checks]).reshape(len(checks), len(languages))
    t = temperature(logits, np.array([label for label, _, _ in checks], dtype=int))
    return Model(languages, (w[:-1] * idf[:, None] * 20.0 / t).astype(np.float32), w[-1] / t)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs``; only text is read to predict."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [held.value.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 5, held_fold: int = 0, sample: int = SAMPLE) -> DataFrame:
    """Predictions for every document by a model that has not seen the fold crc32(doc_id) mod ``folds`` = ``held_fold``."""
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == held_fold
    model = fit(docs, ~held_out, sample)
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
