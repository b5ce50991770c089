"""Importance resampling towards a target distribution, by hashed word features.

A text's features are its runs of ``low`` to ``high`` consecutive words, counted into ``buckets`` by CRC-32. A bucket's
gain is the scaled logarithm of its smoothed share in the target over that in the corpus; a document's weight is the
mean gain of its features; a seeded Gumbel term of its doc_id turns weights into a draw without replacement.

Words come from an untrained pre-tokenizer (a regular expression's Split) over the text with A-Z lowered; windows are
taken over its offset pairs. Each text is split once and its buckets are kept as a table: counts, gains and weights
are array sums over that table. One number a bucket reaches the driver, and one a distinct score: weights lie
between two gains and the Gumbel term between -3,106 and 22,873, so there are some 100,000 scores at most.

Defined cases. A null text has no words. Without features the weight is 0. A null doc_id is drawn by the digest of an empty
id and comes last among ties. Repeated rows are drawn row by row. Very long texts are split piece by piece at
separators. An empty corpus gives an empty result, an empty target equal shares for all buckets. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideskein.llm.common import cut, in_order, slices

#: Letters and digits of ASCII after lowering, and anything beyond ASCII.
FEATURE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 2024
#: Characters that are split at a time.
PIECE = 1 << 18
#: Features whose buckets a Python worker keeps.
_MEMO = 100_000
_SEPARATOR = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def _pieces(text: str, most: int) -> Iterator[str]:
    """The text in pieces that end at separators, of about ``most`` characters."""
    at = 0
    while len(text) - at > most:
        found = _SEPARATOR.search(text, at + most)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


class Features:
    """Buckets of a text's features, in order; made anew in each task."""

    def __init__(self, low: int = 1, high: int = 1, buckets: int = BUCKETS) -> None:
        from tokenizers import Regex, pre_tokenizers

        self.low, self.high, self.buckets = low, high, buckets
        self.split = pre_tokenizers.Split(Regex(FEATURE_WORD), "removed", invert=True)
        self.memo: dict[str, int] = {}

    def bucket(self, feature: str) -> int:
        if len(self.memo) >= _MEMO:
            self.memo.clear()
        found = self.memo[feature] = zlib.crc32(feature.encode("utf-8", "surrogatepass")) % self.buckets
        return found

    def of(self, text: str | None, piece: int = PIECE) -> tuple[int, np.ndarray]:
        """How many words the text has, and the buckets of its features."""
        lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        words = [w for part in _pieces(lowered, piece) for w, _ in self.split.pre_tokenize_str(part)]
        memo, bucket, found = self.memo, self.bucket, []
        for n in range(self.low, self.high + 1):
            features = words if n == 1 else (" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
            found += [memo[f] if f in memo else bucket(f) for f in features]
        return len(words), np.array(found, dtype=np.int32)


def featured(docs: DataFrame, low: int = 1, high: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words and buckets (one a feature) of each row; ``docs`` has doc_id and text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(low, high, buckets)
        for batch in slices(batches):
            made = [features.of(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *(len(b) for _, b in made)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *(b for _, b in made)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in made], pa.int64()), lists], names=["doc_id", "n_words", "buckets"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_words long, buckets array<int>")


def _each(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches, the values of their lists end to end, and the lists' ends."""
    for batch in batches:
        lists = batch.column(column)
        ends = lists.offsets.to_numpy()
        yield batch, lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]], ends - ends[0]


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows: summed within each task, then over the tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for _, values, _ in _each(batches, "buckets"):
            counts += np.bincount(values, minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    found = np.zeros(buckets, dtype=np.int64)
    for r in rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        found[r.bucket] = r.n
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, from its counts in the corpus and in the target."""
    size, s, t = len(corpus), corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + size)) / ((s + 1) * (t.sum() + size)))).astype(np.int64)


def weights(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight (mean gain, rounded down) of rows with buckets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values, ends in _each(batches, "buckets"):
            total = np.concatenate([[0], np.cumsum(gain[values])])
            n = np.diff(ends).astype(np.int64)
            mean = (total[ends[1:]] - total[ends[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(n), pa.array(mean)], names=["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int = SEED) -> Column:
    """A seeded standard Gumbel value of doc_id in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, low: int = 1, high: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; rank is null for rows that are not drawn.

    ``target`` has a column text. Of the N rows with at least ``least_words`` words, percent * N // 100 are drawn.
    """
    rows = cut(featured(docs, low, high, buckets), "resample-buckets")
    goal = featured(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), low, high, buckets)
    gain = gains(histogram(rows, buckets), histogram(goal, buckets))
    scored = cut(weights(rows, gain).withColumn("score", (F.col("weight") + gumbel(seed)).cast("long")), "resample-scores")
    able = F.col("n_words") >= least_words
    counts = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("score")).collect()  # bounded: distinct scores
    drawn = percent * sum(r.n for r in counts) // 100
    least, above = None, 0
    for r in counts:
        if above >= drawn:
            break
        least, above = r.score, above + r.n
    near = able & (F.col("score") >= least) if least is not None else F.lit(False)
    ranked = in_order(scored.where(near), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "_place", "resample-ranked")
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1)
    out = ["doc_id", "n_features", "weight", "score"]
    return scored.where(~near).select(*out, F.lit(None).cast("long").alias("rank")).unionByName(ranked.select(*out, rank.alias("rank")))
