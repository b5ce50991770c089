"""SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Two fingerprints that differ in at most three bits share at least
five of them, the guaranteed minimum. Postings of one (position, byte) pair would hold n/256 fingerprints
each, so the index is keyed by three positional bytes at a time: of any five shared positions three lie in the
same half of the eight, so the eight triples inside the halves meet every such pair. Inside a posting the
shared positional bytes of a pair are tallied, pairs with fewer than five are dropped, and the rest are
verified by their differing bits.

Only distinct fingerprints are indexed, so copies cost one entry. A posting is searched in numpy and yields a
spanning forest of its links, never all pairs. A posting longer than ``DENSE`` is refined, not capped: its
fingerprints go to the ten five-byte keys that hold the posting's three bytes (the pair shares five positions, so
one such key at least). In a five-byte posting still longer than ``DENSE`` 24 bits are left, of which a link
differs in three at most, so one quarter of them is equal: its fingerprints are grouped by each quarter, which
leaves 18 bits and so at most 2^18 fingerprints a group, and links are looked up bit by bit in a table of that size.
Index keys that hold more than one part in ``HOT_SHARE`` of the index (so fewer than ``HOT_SHARE`` of them) skip the
posting and are refined at once, on all executors.

Defined cases. A null text has no words; texts without words have fingerprint zero and are linked like any
other. Repeated rows share a fingerprint. A null doc_id gets a component but names none, unless all its
members are null. An empty table gives an empty result. Extra columns are ignored by
:func:`near_duplicates`; :func:`keep_one` passes them through, names beginning with ``_near_`` are reserved.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideskein.llm.common import cut, keep_first, slices, text_hash
from wideskein.llm.components import components

SHINGLE = 3
SEED = 42
MOST_BITS = 3
LEAST_BYTES = 5
DENSE = 4096
HOT_SHARE = 512
BROADCAST_IDS = 1_000_000

TRIPLES = [(*c,) for half in (range(4), range(4, 8)) for c in itertools.combinations(half, 3)]
FIVES = list(itertools.combinations(range(8), 5))


def fingerprint(text: str | None) -> int:
    """64-bit majority of the shingles' XXH64; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_digest, b" ".join
    raw = b"".join([digest(join(s), SEED) for s in zip(words, words[1:], words[2:], strict=False)])
    n = len(words) - SHINGLE + 1
    counts = np.zeros(64, dtype=np.int64)
    hashes = np.frombuffer(raw, dtype=np.uint8).reshape(n, 8)
    for start in range(0, n, 8192):
        counts += np.unpackbits(hashes[start : start + 8192], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        prints = [fingerprint(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], names=["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and fp, the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_hash().alias("text_hash"))
    return rows.mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 56 - 8 * position).bitwiseAND(F.lit(255))


def _key(fp: Column, positions: tuple[int, ...], tag: int) -> Column:
    key = F.lit(tag).cast("long")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(_byte(fp, p))
    return key


def _index(prints: DataFrame, groups: list[tuple[int, ...]]) -> DataFrame:
    fp = F.col("fp")
    return prints.select("fp", F.explode(F.array(*(_key(fp, g, tag) for tag, g in enumerate(groups)))).alias("key"))


def _linked(one: np.uint64, many: np.ndarray) -> np.ndarray:
    """Which of ``many`` are links of ``one``: tally shared positional bytes, keep those with enough, verify bits."""
    differ = np.bitwise_xor(many, one)
    shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    out = np.zeros(len(many), dtype=bool)
    passed = np.flatnonzero(shared >= LEAST_BYTES)
    out[passed] = np.bitwise_count(differ[passed]) <= MOST_BITS
    return out


def _forest(posting: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the posting as all its links would: breadth first, each fingerprint reached once."""
    links: list[tuple[int, int]] = []
    rest = posting
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            near = _linked(one, rest)
            if near.any():
                found = rest[near]
                links.extend((int(one), int(x)) for x in found)
                queue.extend(found)
                rest = rest[~near]
    return links


def _search(dense: int):
    """Over (key, fp) sorted by key: links of postings up to ``dense``, and the fingerprints of longer ones to be refined."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])

    def emit(a: np.ndarray, b: np.ndarray, key: np.ndarray, null: bool) -> pa.RecordBatch:
        rest = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), rest if null else pa.array(b.view(np.int64)), pa.array(key) if null else rest], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_key, over = [], None, False
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
            else:
                keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                prints = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                if not len(keys):
                    continue
            edges = np.flatnonzero(np.diff(keys)) + 1
            starts = np.concatenate([[0], edges]).astype(np.int64) if len(keys) else np.empty(0, np.int64)
            ends = np.concatenate([edges, [len(keys)]]).astype(np.int64) if len(keys) else np.empty(0, np.int64)
            links: list[tuple[int, int]] = []

            def close() -> None:
                if held and not over and sum(map(len, held)) > 1:
                    links.extend(_forest(np.concatenate(held)))

            wide = np.flatnonzero(ends - starts > 1)
            todo = sorted({0, len(starts) - 1, *wide.tolist()}) if len(starts) else []
            for i in todo:
                key, part = int(keys[starts[i]]), prints[starts[i] : ends[i]]
                if key != held_key:
                    close()
                    held, held_key, over = [], key, False
                held.append(part)
                if over or sum(map(len, held)) > dense:
                    passed = np.concatenate(held)
                    yield emit(passed, passed, np.full(len(passed), key, np.int64), True)
                    held, over = [], True
            if batch is None:
                close()
            if links:
                pairs = np.array(links, dtype=np.uint64)
                yield emit(pairs[:, 0].copy(), pairs[:, 1].copy(), np.empty(0, np.int64), False)

    return run


def _postings(index: DataFrame, dense: int, name: str) -> DataFrame:
    parts = index.repartition("key").sortWithinPartitions("key").select("key", "fp")
    return cut(parts.mapInArrow(_search(dense), "a long, b long, key long"), name)


def _quarters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For (key, fp) of long five-byte postings: key, part (which quarter of the 24 bits left, and its six bits), rest (the other 18) and fp."""
    for batch in batches:
        keys, prints = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        for tag in np.unique(keys >> 40):
            mine = keys >> 40 == tag
            key, fp = keys[mine], prints[mine].view(np.uint64)
            left = np.zeros(len(fp), dtype=np.uint64)
            for p in range(8):
                if p not in FIVES[tag]:
                    left = left << np.uint64(8) | fp >> np.uint64(56 - 8 * p) & np.uint64(255)
            left = left.astype(np.int64)
            for quarter in range(4):
                below = 18 - 6 * quarter
                part = 64 * quarter + (left >> below & 63)
                rest = (left >> below + 6) << below | left & (1 << below) - 1
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part.astype(np.int32)), pa.array(rest.astype(np.int32)), pa.array(fp.view(np.int64))], names=["key", "part", "rest", "fp"])


_FLIPS = np.array(sorted({x | y | z for x, y, z in itertools.product([1 << b for b in range(18)], repeat=3)}))


def _by_bits(table: pa.Table) -> pa.Table:
    """Links of one group of :func:`_quarters`: every fingerprint to the first one it reaches over ``rest`` that differ in three bits at most."""
    rest, fp = table["rest"].to_numpy(), table["fp"].to_numpy()
    place = np.full(1 << 18, -1, dtype=np.int64)
    place[rest] = np.arange(len(rest))
    root, before = np.arange(len(rest)), None
    while before is None or (root != before).any():
        before = root.copy()
        for flip in _FLIPS:
            other = place[rest ^ flip]
            root = np.where(other >= 0, np.minimum(root, root[other]), root)
        root = root[root]
    linked = np.flatnonzero(root != np.arange(len(rest)))
    return pa.table({"a": fp[linked], "b": fp[root[linked]]})


def links(prints: DataFrame, dense: int = DENSE, hot_share: int = HOT_SHARE) -> DataFrame:
    """a, b: links among distinct fingerprints (column fp) that connect them as all links within three bits do."""
    index = _index(prints, TRIPLES)
    total = 8 * prints.count()
    counts = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(dense, total // hot_share))
    hot = cut(counts.select("key"), "simhash-hot")
    n_hot = hot.count()
    usual = index.join(F.broadcast(hot), "key", "left_anti") if n_hot else index
    found = _postings(usual, dense, "simhash-triples")
    refine = found.where("b is null").select("key", F.col("a").alias("fp"))
    if n_hot:
        refine = refine.unionByName(index.join(F.broadcast(hot), "key", "left_semi").select("key", "fp"))
    refine = cut(refine, "simhash-refine")
    out = found.where("b is not null").select("a", "b")
    if refine.isEmpty():
        return out
    held = F.when(F.lit(False), F.array().cast("array<bigint>"))
    for tag, triple in enumerate(TRIPLES):
        fives = [_key(F.col("fp"), g, i) for i, g in enumerate(FIVES) if set(triple) < set(g)]
        held = held.when(F.shiftright("key", 24) == tag, F.array(*fives))
    fives = _postings(refine.select("fp", F.explode(held).alias("key")).distinct(), dense, "simhash-fives")
    out = out.unionByName(fives.where("b is not null").select("a", "b"))
    long = fives.where("b is null").select("key", F.col("a").alias("fp"))
    if long.isEmpty():
        return out
    parts = long.mapInArrow(_quarters, "key long, part int, rest int, fp long")
    # A group holds 2^18 fingerprints at most, as they are distinct.
    return out.unionByName(parts.groupBy("key", "part").applyInArrow(_by_bits, "a long, b long"))


def _grouped(docs: DataFrame, dense: int, hot_share: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, text_hash and fp of every row; fp, root (of its component) and component_id of every fingerprint."""
    rows = cut(fingerprints(docs), "simhash-rows")
    prints = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    found = components(links(prints.select("fp"), dense, hot_share))
    named = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    grouped = cut(named.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-groups")
    return rows, named.select("fp", "root").join(grouped, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, dense: int = DENSE, hot_share: int = HOT_SHARE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of every document."""
    rows, classes = _grouped(docs, dense, hot_share)
    return rows.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def text_links(docs: DataFrame, dense: int = DENSE, hot_share: int = HOT_SHARE) -> DataFrame:
    """a, b: hashes of texts whose links connect them as the links of their fingerprints do; texts of one fingerprint are linked to the least of them."""
    rows = cut(fingerprints(docs), "simhash-rows")
    prints = cut(rows.groupBy("fp").agg(F.min("text_hash").alias("text"), F.max("text_hash").alias("last")), "simhash-prints")
    shared = cut(prints.where("text < last").select("fp", F.col("text").alias("a")), "simhash-shared")
    if shared.count() <= BROADCAST_IDS:
        shared = F.broadcast(shared)
    same = rows.join(shared, "fp").select("a", F.col("text_hash").alias("b")).where("a <> b").distinct()
    named = lambda c: prints.select(F.col("fp").alias(c), F.col("text").alias(f"text_{c}"))
    found = cut(links(prints.select("fp"), dense, hot_share), "simhash-links").join(named("a"), "a").join(named("b"), "b")
    return same.unionByName(found.select(F.col("text_a").alias("a"), F.col("text_b").alias("b")))


def keep_one(docs: DataFrame, dense: int = DENSE, hot_share: int = HOT_SHARE) -> DataFrame:
    """The rows of ``docs`` with one row of each group of near duplicates, the one with the smallest doc_id.

    Rows are told apart by doc_id and text (:func:`common.keep_first`), so a group without ids keeps one row too.
    Up to ``BROADCAST_IDS`` decisions are sent to the scan; beyond that both sides are shuffled.
    """
    rows, classes = _grouped(docs, dense, hot_share)
    grouped = rows.join(classes, "fp").select("doc_id", "text_hash", F.col("root").alias("group"))
    return keep_first(docs, grouped, BROADCAST_IDS, "simhash-decided")
