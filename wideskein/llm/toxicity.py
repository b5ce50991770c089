"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are the lower-cased letter words of the whole text and their first 4 to 7 letters, each as present
or absent, and once more as repeated (``+``) or not. The model is learned from at most about ``SAMPLE``
labelled documents, half of them toxic where there are as many, picked by a hash of doc_id. Their counts
screen the features: those in at least ``LEAST_DOCS`` toxic documents, ``RATIO`` times as often there as in
clean ones, and beyond what chance gives among all features tested (a log-likelihood margin of ``MARGIN``).
All that pass are used; the elastic net says which of them count.

Labels say toxic or not; grades come from them and from what models that have not seen the document say of it. The
labelled documents fall into ``FOLDS`` folds, each fold trains a model of its own, and the grade of a toxic document
is how many models of the other three folds find it toxic, one at least; a clean one has grade 0. One weight vector
is shared by the thresholds t1 < t2 < t3 of P(grade >= k) = sigmoid(w.x - t_k); it is fitted by proximal gradient
steps with elastic-net penalties. Severity is the expected grade, the sum of P(grade >= k) over k. A document is
toxic if P(grade >= 1) >= ``REJECT``.

Defined cases. A null or empty text has no features and gets the score of none. Labels that are null, or
whose document is missing, teach nothing; without a toxic and a clean label every document is clean with
severity 0. Repeated rows are scored alike. A null doc_id is scored too. Very long texts are read in whole. Extra
columns are ignored by :func:`score` and pass through :func:`keep_clean`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideskein.llm.common import cut, slices

SAMPLE = 16_000
LEAST_DOCS = 4
RATIO = 8
MARGIN = 4.0
LISTED = 300_000
FOLDS = 4
GRADES = FOLDS - 1
REJECT = 0.5
PREFIXES = range(4, 8)
_WORDS = re.compile(r"[^\W\d_]+")
#: Words whose features a Python worker keeps.
_MEMO = 40_000


def word_features(word: str) -> list[str]:
    """A word's features: itself, and ``^`` with its first 4 to 7 letters if it is longer."""
    return [word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]


def words(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def features_in(text: str | None, known: set[str] | None = None, memo: dict[str, tuple] | None = None) -> list[str]:
    """A text's features, or those whose plain form is in ``known``; ``memo`` keeps what is known of a word."""
    counts: dict[str, int] = {}
    memo = {} if memo is None else memo
    if len(memo) > _MEMO:
        memo.clear()
    for w, n in Counter(words(text)).items():
        hit = memo.get(w)
        if hit is None:
            hit = word_features(w)
            if known is not None:
                hit = memo[w] = tuple(f for f in hit if f in known) or ()
        for f in hit:
            counts[f] = counts.get(f, 0) + n
    return [*counts, *(f + "+" for f, n in counts.items() if n > 1)]


def _plain(names) -> set[str]:
    return {f.rstrip("+") for f in names}


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: np.ndarray
    _memo: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._known = _plain(self.weights)

    def evidence(self, text: str | None) -> float:
        weights = self.weights
        return sum(weights.get(f, 0.0) for f in sorted(features_in(text, self._known, self._memo)))

    def at_least(self, text: str | None) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds - self.evidence(text), -50, 50)))

    def __reduce__(self):
        return Model, (self.weights, self.thresholds)


def screen(labelled: DataFrame, least: int = LEAST_DOCS) -> tuple[list[tuple[str, int, int]], int, int]:
    """(feature, toxic documents, clean documents) of the telling features, and how many documents of either kind there are."""

    def listed(known: set[str] | None):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo: dict[str, tuple] = {}
            for batch in slices(batches, 128):
                found = Counter(f for text in batch.column(0).to_pylist() for f in features_in(text, known, memo))
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["feature", "n"])

        return run

    sizes = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return [], n1, n0
    toxic = labelled.where("toxic = 1").select("text").mapInArrow(listed(None), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n1"))
    toxic = cut(toxic.where(F.col("n1") >= least), "toxic-features")
    tested = toxic.count()
    # Clean documents count only features that toxic ones have; up to LISTED of them their readers get the list.
    known = _plain(toxic.select("feature").toPandas()["feature"]) if tested <= LISTED else None
    clean = labelled.where("toxic = 0").select("text").mapInArrow(listed(known), "feature string, n long")
    clean = clean.join(toxic.select("feature"), "feature", "left_semi").groupBy("feature").agg(F.sum("n").alias("n0"))
    both = toxic.join(clean, "feature", "left").na.fill(0, ["n0"])
    p1, p0 = (F.col("n1") + 0.5) / (n1 + 1.0), (F.col("n0") + 0.5) / (n0 + 1.0)
    # Log-likelihood gain of the feature's own toxic share over the common one; chance reaches log(tested) among so many features.
    n, toxic_share = F.col("n1") + F.col("n0"), n1 / (n1 + n0)
    telling = F.col("n1") * F.log(F.col("n1") / (n * toxic_share)) + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / (n * (1 - toxic_share)))).otherwise(0.0)
    top = both.where((p1 > RATIO * p0) & (telling > math.log(max(tested, 1)) + MARGIN)).select("feature", "n1", "n0").orderBy("feature").collect()
    return [(r.feature, r.n1, r.n0) for r in top], n1, n0


@dataclass
class Sparse:
    """Rows of present features: row and feature of each, side by side."""

    row: np.ndarray
    feature: np.ndarray
    rows: int
    features: int

    @classmethod
    def of(cls, lists: list[list[int]], features: int) -> Sparse:
        return cls(np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.array([f for x in lists for f in x], dtype=np.int64), len(lists), features)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.feature], minlength=self.rows)

    def sums(self, of_rows: np.ndarray) -> np.ndarray:
        return np.bincount(self.feature, weights=of_rows[self.row], minlength=self.features)


def _fit_ordinal(x: Sparse, y: np.ndarray, grades: int, l1: float = 0.0001, l2: float = 0.00002, steps: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by accelerated proximal gradient on the binary losses of y >= k."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))  # toxic and clean count alike
    target = (y[:, None] >= np.arange(1, grades + 1)[None, :]).astype(np.float64)
    step = 4.0 / (grades * max(1.0, float(share[x.row].sum())) + grades)
    w, t = np.zeros(x.features), np.linspace(1.0, 2.0, grades)
    pw, pt, momentum = w, t, 1.0
    for _ in range(steps):
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        k = (momentum - 1) / faster
        vw, vt = w + k * (w - pw), t + k * (t - pt)
        pw, pt, momentum = w, t, faster
        error = (1.0 / (1.0 + np.exp(np.clip(vt[None, :] - x.times(vw)[:, None], -50, 50))) - target) * share[:, None]
        w = vw - step * (x.sums(error.sum(axis=1)) + l2 * vw)
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0.0)
        t = np.maximum.accumulate(vt + step * error.sum(axis=0))
    return w, t


def _grades(lists: list[list[int]], toxic: np.ndarray, fold: np.ndarray, features: int) -> np.ndarray:
    """0 for clean rows; for toxic ones the models of other folds that find them toxic, one at least."""
    votes, x = np.zeros(len(lists), dtype=np.int64), Sparse.of(lists, features)
    for f in range(FOLDS):
        mine = np.flatnonzero(fold == f)
        if not toxic[mine].any() or toxic[mine].all():
            continue
        w, t = _fit_ordinal(Sparse.of([lists[i] for i in mine], features), toxic[mine], 1, steps=300)
        votes += (x.times(w) >= t[0]) & (fold != f)
    return np.where(toxic == 1, np.clip(votes, 1, GRADES), 0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the documents that ``labels`` (doc_id, toxic) covers."""
    y = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where("toxic in (0, 1)")
    sizes = {r.toxic: r.n for r in y.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, F.lit(sample / 2 / sizes.get(1, 1))).otherwise(F.lit(sample / 2 / sizes.get(0, 1)))
    picked = y.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < share * (1 << 30))
    # The sample's bound holds for the labels sent to the scan and for the texts kept.
    labelled = cut(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(picked), "doc_id"), "toxic-sample")
    found, *_ = screen(labelled)
    if not found:
        return Model({}, np.full(GRADES, 60.0))
    names = {f: i for i, (f, _, _) in enumerate(found)}
    plain = _plain(names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple] = {}
        for batch in slices(batches):
            at = [sorted(names[f] for f in features_in(text, plain, memo) if f in names) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at, pa.list_(pa.int32()))], names=["doc_id", "toxic", "at"])

    rows = labelled.select("doc_id", "toxic", "text").mapInArrow(run, "doc_id long, toxic int, at array<int>").toArrow().sort_by("doc_id")
    lists, toxic = rows["at"].to_pylist(), rows["toxic"].to_numpy()
    y = _grades(lists, toxic, np.arange(len(lists)) % FOLDS, len(names))
    w, t = _fit_ordinal(Sparse.of(lists, len(names)), y, GRADES)
    return Model({f: float(w[i]) for f, i in names.items() if w[i] != 0.0}, t)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic and toxic (boolean) of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = np.array([held.value.at_least(t) for t in batch.column(1).to_pylist()]).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(p[:, 0] >= REJECT)], names=["doc_id", "severity", "p_toxic", "toxic"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, severity double, p_toxic double, toxic boolean")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, all columns as they were; no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([bool(held.value.at_least(t)[0] < REJECT) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
