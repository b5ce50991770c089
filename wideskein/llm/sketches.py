"""Document fingerprints: bottom-k sketches of hashed word shingles.

A sketch holds the ``K`` smallest distinct 64-bit hashes of a document's five-word shingles (fewer words: the
whole sequence is one shingle; no words: an empty sketch). Sketches of parts merge into the sketch of the
whole, and two sketches give estimates of resemblance, containment and distinct shingles.

Defined cases. A null text counts as empty. Two empty sketches resemble each other fully, an empty and a
filled one not at all. Rows are put in descending order of doc_id, null doc_ids last, ties by a hash of the text;
repeated rows follow each other. A table of one row is its own next document; an empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideskein.llm.common import slices, text_or_empty

K = 128
SHINGLE = 5
#: Bytes of text in a range of documents.
RANGE_BYTES = 64 << 20
_MASK = (1 << 64) - 1
#: Words whose hashes a Python worker keeps.
_MEMO = 300_000
_word_hashes: dict[bytes, int] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_word_hashes) > _MEMO:
        _word_hashes.clear()
    known = _word_hashes.get
    found = list(map(known, words))
    if None in found:
        for i, h in enumerate(found):
            if h is None:
                w = words[i]
                found[i] = _word_hashes[w] = xxhash.xxh64_intdigest(w, 7)
    return np.array(found, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that scatters 64-bit values (two multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str, width: int = SHINGLE) -> np.ndarray:
    """One hash a shingle, repeats included: an order-dependent sum of the word hashes, scattered."""
    hashes = word_hashes(text.encode("utf-8", "surrogatepass").split())
    n = len(hashes)
    if not n:
        return hashes
    width_here = min(width, n)
    total = np.zeros(n - width_here + 1, dtype=np.uint64)
    for i in range(width_here):
        total = mix(total + hashes[i : n - width_here + 1 + i])
    return total


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes, ascending."""
    if len(hashes) > 8 * k:
        low = np.unique(np.partition(hashes, 4 * k)[: 4 * k])
        if len(low) >= k:
            return low[:k]
    return np.unique(hashes)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact while the sketch isn't full."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness: the share of the union's k smallest hashes that both hold."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k)
    return float(np.isin(union, a[np.isin(a, b)]).sum() / len(union))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype=">u8").astype(np.uint64)


def document_sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_shingles (estimate of the distinct ones) and fingerprint of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [sketch(shingle_hashes(t), k) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([distinct(m, k) for m in made], pa.float64()), pa.array([to_text(m) for m in made], pa.string())], names=["doc_id", "n_shingles", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_shingles double, fingerprint string")


def merged_sketches(sketches: DataFrame, key: str, k: int = K) -> DataFrame:
    """One sketch per value of ``key``: the k smallest of the group's hashes. Each task first merges what it holds, so a group costs one row a task."""
    kind = sketches.schema[key].dataType.simpleString()

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for g, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one = from_text(text)
                held[g] = merge(held[g], one, k) if g in held else one
        if held:
            yield pa.RecordBatch.from_pydict({key: list(held), "fingerprint": [to_text(x) for x in held.values()]})

    schema = f"`{key}` {kind}, fingerprint string"
    rows = sketches.select(key, "fingerprint")
    return rows.mapInArrow(local, schema).repartition(key).mapInArrow(local, schema)


def _ranged(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text, tie (a hash of the text) and range of every row, and the number of ranges, of about ``RANGE_BYTES`` each.

    Ranges go down by doc_id, those of rows without one come last. A doc_id that alone fills several ranges, or the
    lack of one, is split by the tie, which also orders its rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).withColumn("tie", F.xxhash64("text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("named"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size.bytes or 0) // RANGE_BYTES))
    at = [i / parts for i in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("doc_id", at, 10 * parts)).first()[0] if at else None
    values, first, times, below, last = [], [], [], [], 0
    for value, n in sorted(Counter(bounds or []).items(), reverse=True):
        values.append(value)
        times.append(n)
        first.append(last + 1)
        # The rows of a bound that came several times have ranges of their own, others go with what is below.
        last += 1 if n == 1 else n + 1
        below.append(last)
    unnamed = max(1, round(parts * (size.n - size.named) / size.n)) if size.n else 1
    longs = lambda x: F.expr(f"array({', '.join(f'{v}L' if v > -(2**63) else 'bigint(-9223372036854775808)' for v in x)})")
    nth = lambda of: F.least(F.floor((F.col("tie").cast("double") / 2.0**64 + 0.5) * of), of - 1)
    place = F.lit(0).cast("long")
    if values:
        above = F.size(F.filter(longs(values), lambda v: v >= F.col("doc_id")))
        here = F.element_at(longs(values), above) == F.col("doc_id")
        place = F.when(above == 0, place).when(here, F.element_at(longs(first), above) + nth(F.element_at(longs(times), above))).otherwise(F.element_at(longs(below), above))
    place = F.when(F.col("doc_id").isNull(), last + 1 + nth(F.lit(unnamed))).otherwise(place)
    return rows.withColumn("range", place.cast("int")), last + 1 + unnamed


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (range, guest, doc_id, text) partitioned by range and sorted so that each document is followed by its next one.

    Ranges keep the order without one global sort; the first document of a range comes once more, as a guest,
    after the last row of the range before it (the very first after the very last). Each text moves once.
    """
    spark = docs.sparkSession
    ranged, ranges = _ranged(docs)
    first = F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id"), F.col("tie"))
    heads = sorted((r.range, r.head[1], r.head[2]) for r in ranged.groupBy("range").agg(F.min(first).alias("head")).collect())
    table = [(heads[i - 1][0], r, None if doc_id is None else ~doc_id, tie) for i, (r, doc_id, tie) in enumerate(heads)]
    table = spark.createDataFrame(table, "guest_of int, range int, head long, head_tie long")
    lead = ranged.join(F.broadcast(table), "range").where("doc_id <=> head and tie = head_tie")  # a row per range
    guests = lead.groupBy(F.col("guest_of").alias("range"), "doc_id", "tie").agg(F.min("text").alias("text")).withColumn("guest", F.lit(1))
    both = ranged.withColumn("guest", F.lit(0)).unionByName(guests)
    order = ["range", "guest", F.desc_nulls_last("doc_id"), "tie", "text"]
    return both.repartitionById(ranges, F.col("range")).sortWithinPartitions(*order).select("range", "guest", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """The last third of ``text`` (code points, rounded down) replaced by as many of ``following``'s first, or all."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third] if third else text


def fingerprint_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Each document's fingerprint, its edited text's, and the likeness of the first to the second and to the next document's."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in slices(batches, 128):
            out: list[tuple] = []
            for where, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = shingle_hashes(text)
                own = sketch(mine, k)
                if last and last[0] == where:
                    _, other_id, other_text, other = last
                    changed = edited(other_text, text)
                    theirs = other if changed == other_text else sketch(shingle_hashes(changed), k)
                    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((other_id, len(other_text), digest, to_text(other), to_text(theirs), resemblance(other, theirs, k), resemblance(other, own, k)))
                last = None if guest else (where, doc_id, text, own)
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).mapInArrow(run, schema)
