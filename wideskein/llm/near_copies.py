"""Near copies by word shingles: MinHash bands propose, signatures and then whole sets decide, links become components.

Two texts are linked if their sets of word shingles have a Jaccard likeness of a :class:`Rule`'s ``percent`` or more. Sets hold
64-bit hashes. ``BANDS * ROWS`` universal hashes (multiplication by an odd factor modulo 2^64, compared from the top)
give as many minima, and each text goes to ``BANDS`` postings, each keyed by ``ROWS`` of them; a pair at likeness J meets in none with
probability (1 - J^4)^32: 5e-8 at 0.8, less above. A byte of each minimum is the text's signature; a pair at 0.8
agrees in fewer than ``MATCH`` of 128 bytes with probability 1e-8.

Equal postings are searched once. Each text is first compared with the leaders of its postings (``LEADERS`` at most), which
is linear and connects nearly all of a large group. Postings that then still hold several classes are searched:

- up to ``SHORT`` texts, signatures are gathered (128 bytes a text) and the pairs of different classes that agree are named,
  or, where these are more than a few times the texts, the texts are passed on;
- what is passed on, and longer postings, is searched with the whole sets by prefix filter (:func:`within`): rare shingles first, so
  texts that share a template but are no near copies don't meet, and links are found in time that follows the links;
- a posting with more than ``HELD`` shingles is not capped: its texts outside the largest class are dealt into blocks that meet
  each other and the blocks of that class.

Links are confirmed on whole sets. No step holds more than ``HELD`` shingles, or two blocks of them, of a posting in a task.

Defined cases. A null text has no words. Texts without words are linked to each other if the rule says so, else to nothing. A null doc_id
is a document of its own text (:func:`common.keep_first`); in :func:`near_duplicates` it is kept only where its component has no doc_id at
all. Repeated rows are one text. An empty table gives an empty result. Extra columns pass through :func:`keep_one` and are
ignored elsewhere; names beginning with ``_near_`` are reserved.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideskein.llm.common import cut, keep_first, slices, text_hash, text_or_empty
from wideskein.llm.components import components
from wideskein.llm.sketches import SHINGLE, mix

BANDS = 32
ROWS = 4
#: Bytes of 128 in which the signatures of linked texts agree.
MATCH = 76
#: Texts of a posting whose signatures are compared at a stroke.
SHORT = 2048
#: Shingles of a posting that one task searches.
HELD = 1_000_000
LEADERS = 3
#: Postings up to this length have one leader.
AT_ONCE = 64
#: Texts that one copy of a leader's set meets.
A_LEADER = 1000
BROADCAST_IDS = 500_000
_FACTORS = np.random.default_rng(5).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Rule:
    """Shingles of ``width`` words (fewer words: the whole sequence is one); a likeness of ``percent`` links."""

    width: int = SHINGLE
    percent: int = 80
    #: Lower A-Z only, or all letters.
    ascii_only: bool = False
    empty_linked: bool = True

    def shingles(self, text: str | None) -> np.ndarray:
        """Distinct shingle hashes, ascending; words are hashed anew, so that a worker keeps none."""
        text = text or ""
        words = text.encode("utf-8", "surrogatepass").lower().split() if self.ascii_only else text.lower().encode("utf-8", "surrogatepass").split()
        hashes = np.array([xxhash.xxh64_intdigest(w, 7) for w in words], dtype=np.uint64)
        width = min(self.width, len(words))
        total = np.zeros(len(words) - width + 1 if width else 0, dtype=np.uint64)
        for i in range(width):
            total = mix(total + hashes[i : i + len(total)])
        return np.unique(total)

    def linked(self, shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (shared > 0) & (100 * shared >= self.percent * (a + b - shared))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    least = np.full(BANDS * ROWS, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        np.minimum(least, (shingles[at : at + 512, None] * _FACTORS).min(axis=0), out=least)
    return least


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """The keys of the postings a set goes to; sets without shingles meet in one."""
    if not len(shingles):
        return np.zeros(1, dtype=np.uint64)
    keys, least = np.arange(BANDS, dtype=np.uint64), minima(shingles).reshape(BANDS, ROWS)
    for i in range(ROWS):
        keys = mix(keys * np.uint64(31) + least[:, i])
    return keys


def signature(shingles: np.ndarray) -> bytes:
    return (mix(minima(shingles)) >> np.uint64(56)).astype(np.uint8).tobytes() if len(shingles) else bytes(BANDS * ROWS)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate([np.empty(0, np.uint64), *values]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _banded(rule: Rule):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [rule.shingles(t) for t in batch.column(2).to_pylist()]
            keys = [band_keys(s) if len(s) or rule.empty_linked else s for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), _lists(keys)], names=["doc_id", "text_hash", "n_shingles", "bands"])

    return run


def _with_sets(rule: Rule):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [rule.shingles(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([signature(s) for s in sets], pa.binary()), _lists(sets)], names=["text_hash", "signature", "found"])

    return run


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of batches sorted by their first column, by its values; groups of a single row are left out."""
    held, key = [], None
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        edges = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
        for i in sorted({0, len(starts) - 1, *np.flatnonzero(ends - starts > 1).tolist()}):
            if held and keys[starts[i]] != key:
                if sum(h.num_rows for h in held) > 1:
                    yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(starts[i], ends[i] - starts[i]))
            key = keys[starts[i]]
    if sum(h.num_rows for h in held) > 1:
        yield pa.Table.from_batches(held)


def _joined(pairs: Iterable[tuple[np.ndarray, np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Pairs of long columns in batches of some size."""
    held, n = [], 0
    for pair in itertools.chain(pairs, [None]):
        if pair is not None:
            held.append(pair)
            n += len(pair[0])
        if held and (pair is None or n > 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)
            held, n = [], 0


def agreeing(signatures: np.ndarray, classes: np.ndarray, sizes: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of different classes whose signatures and sizes let them be linked."""
    n, found = len(classes), []
    step = max(1, (4 << 20) // (n * signatures.shape[1]))
    for at in range(0, n, step):
        rows = slice(at, at + step)
        same = (signatures[rows, None, :] == signatures[None, :, :]).sum(axis=2, dtype=np.int16) >= MATCH
        same &= classes[rows, None] != classes[None, :]
        a, b = sizes[rows, None], sizes[None, :]
        same &= (100 * np.minimum(a, b) >= rule.percent * np.maximum(a, b)) & (np.arange(n)[None, :] > np.arange(at, at + len(a))[:, None])
        i, j = np.nonzero(same)
        found.append((i + at, j))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def within(sets: list[np.ndarray], classes: np.ndarray, rule: Rule) -> list[tuple[int, int]]:
    """Links that connect the sets of different classes as all links of the rule would.

    Prefix filter with the shingles in order of how many sets have them: of two linked sets the smaller has a shared shingle
    among its first size - ceil(2p/(1+p) * size) + 1, and the larger among its first size - ceil(p * size) + 1. Sets that
    are already connected are not compared.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    links: list[tuple[int, int]] = []
    _, root = np.unique(classes, return_inverse=True)

    def connect(one: int, others: np.ndarray) -> None:
        for i in others.tolist():
            if root[i] != root[one]:
                links.append((one, i))
                root[root == root[i]] = root[one]

    none = np.flatnonzero(sizes == 0)
    if rule.empty_linked and len(none) > 1:
        connect(int(none[0]), none[1:])
    p, starts = rule.percent, np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate([np.empty(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    _, name, times = np.unique(flat, return_inverse=True, return_counts=True)
    rare = np.lexsort((name, times[name], owner))
    rank = np.arange(len(flat)) - starts[owner]
    kept = (rank < (sizes + (-p * sizes) // 100 + 1)[owner]) & (times[name[rare]] > 1)
    name, rank, owner = name[rare][kept], rank[kept], owner[kept]
    indexed = rank < (sizes + (-2 * p * sizes) // (100 + p) + 1)[owner]
    by_name = np.argsort(name, kind="stable")
    posting, members = name[by_name], owner[by_name]
    at = np.searchsorted(owner, np.arange(len(sets) + 1))
    for one in np.argsort(sizes, kind="stable").tolist():
        mine = name[at[one] : at[one + 1]][indexed[at[one] : at[one + 1]]]
        low, high = np.searchsorted(posting, mine), np.searchsorted(posting, mine, side="right")
        if not (high - low > 1).any():
            continue
        near = np.unique(np.concatenate([members[a:b] for a, b in zip(low, high, strict=True)]))
        n = sizes[one]
        near = near[(root[near] != root[one]) & (sizes[near] >= n) & (p * sizes[near] <= 100 * n)]
        while len(near):  # some at a time: what they connect need not be compared
            some, near = near[:64], near[64:]
            both = np.concatenate([sets[i] for i in some])
            hit = sets[one][np.minimum(np.searchsorted(sets[one], both), n - 1)] == both
            total = np.concatenate([[0], np.cumsum(hit)])
            ends = np.cumsum(sizes[some])
            connect(one, some[rule.linked(total[ends] - total[ends - sizes[some]], n, sizes[some])])
            near = near[root[near] != root[one]]
    return links


def _agreed(rule: Rule):
    """Of (posting, text_hash, class, n_shingles, signature) sorted by posting: pairs that agree, or posting and text (b null) where these are many."""
    names = ["posting", "a", "b"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            texts, classes, sizes = (table.column(i).to_numpy() for i in (1, 2, 3))
            signatures = np.frombuffer(b"".join(table.column(4).to_pylist()), dtype=np.uint8).reshape(len(texts), -1)
            i, j = agreeing(signatures, classes, sizes, rule)
            if not len(i):
                continue
            posting = table.column(0)[0].as_py()
            if len(i) <= 4 * len(texts) + 64:
                a, b = pa.array(texts[i]), pa.array(texts[j])
            else:
                a = pa.array(texts[np.unique(np.concatenate([i, j]))])
                b = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), posting)), a, b], names=names)

    return run


def _searched(rule: Rule):
    """Of (posting, text_hash, class, set) sorted by posting: links of different classes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for table in _groups(batches):
                texts, classes, lists = table.column(1).to_numpy(), table.column(2).to_numpy(), table.column(3).combine_chunks()
                ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
                linked = np.array(within([flat[a:b] for a, b in itertools.pairwise(ends)], classes, rule), dtype=np.int64).reshape(-1, 2)
                if len(linked):
                    yield texts[linked[:, 0]], texts[linked[:, 1]]

        return _joined(found(), ["a", "b"])

    return run


def _sized(table: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it is small enough."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def _postings(bands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """key and leaders of each distinct posting of two texts or more, and key and text_hash of their texts.

    Postings of the same texts are one. Leaders are the least texts by ``LEADERS`` orders; short postings have one.
    All by map-side aggregation: a posting of any length is in no single task.
    """
    index = bands.select(F.explode("bands").alias("key"), "text_hash")
    keys = index.groupBy("key").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high")).where("low < high")
    index = cut(index.join(_sized(cut(keys.select("key"), "near-keys")), "key", "left_semi").distinct(), "near-index")
    least = [F.min_by("text_hash", F.xxhash64("text_hash", F.lit(i))).alias(f"leader{i}") for i in range(LEADERS)]
    same = [F.bit_xor(F.xxhash64("text_hash", F.lit(i))).alias(f"same{i}") for i in (101, 102)]
    each = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *same, *least)
    firsts = [F.first(f"leader{i}").alias(f"leader{i}") for i in range(LEADERS)]
    each = each.groupBy("n", "same101", "same102").agg(F.min("key").alias("key"), *firsts)
    leaders = F.when(F.col("n") > AT_ONCE, F.array(*(f"leader{i}" for i in range(LEADERS)))).otherwise(F.array("leader0"))
    postings = cut(each.select("key", leaders.alias("leaders")), "near-postings")
    members = cut(index.join(_sized(postings.select("key")), "key", "left_semi"), "near-members")
    return postings, members


def _leading(postings: DataFrame, members: DataFrame) -> DataFrame:
    """a, b: each text b with the leaders that most of its postings have, ``LEADERS`` at most."""
    led = members.join(_sized(postings), "key")
    modes = led.groupBy("text_hash").agg(*(F.mode(F.coalesce(F.try_element_at("leaders", F.lit(i + 1)), F.element_at("leaders", 1)), True).alias(f"leader{i}") for i in range(LEADERS)))
    return modes.select(F.explode(F.array_distinct(F.array(*(f"leader{i}" for i in range(LEADERS))))).alias("a"), F.col("text_hash").alias("b")).where("a <> b")


def confirmed(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) that are linked: first by their signatures, then, of those, by their whole sets.

    What stands for an ``a`` is copied once for every ``A_LEADER`` of its pairs, which so are dealt to as many keys. It is what stands for
    each ``b`` that goes to them, as there are few ``a``; only what is in a pair is sent.
    """
    pairs = cut(pairs, "near-pairs")
    often = cut(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / A_LEADER).cast("int").alias("salts")), "near-often")
    pairs = pairs.join(_sized(often), "a").select("a", "b", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"))

    def beside(some: DataFrame, column: str) -> DataFrame:
        of_b = _sized(some).join(sets.select(F.col("text_hash").alias("b"), F.col(column).alias("of_b")), "b")
        keys = _sized(cut(some.select("a", "salt").distinct(), "near-salted"))
        of_a = keys.join(sets.select(F.col("text_hash").alias("a"), F.col(column).alias("of_a")), "a")
        return of_b.join(of_a, ["a", "salt"])

    def agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for i in (3, 4))
            yield batch.select([0, 1, 2]).filter(pa.array((x == y).sum(axis=1) >= MATCH))

    alike = beside(cut(pairs, "near-dealt"), "signature").select("a", "b", "salt", "of_a", "of_b").mapInArrow(agree, "a long, b long, salt int")
    both = F.size(F.array_intersect("of_a", "of_b"))
    linked = 100 * both >= rule.percent * (F.size("of_a") + F.size("of_b") - both)
    return beside(cut(alike, "near-alike"), "found").where(linked).select("a", "b")


def _classed(members: DataFrame, links: DataFrame, sizes: DataFrame) -> DataFrame:
    """key, text_hash, class, n_shingles of the texts in postings that the links leave in several classes, with the posting's n and shingles."""
    found = components(links).select(F.col("node").alias("text_hash"), "root")
    classed = cut(members.join(_sized(cut(found, "near-classes")), "text_hash", "left").select("key", "text_hash", F.coalesce("root", "text_hash").alias("class")), "near-classed")
    mixed = classed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    left = classed.join(_sized(cut(mixed.select("key"), "near-mixed")), "key", "left_semi")
    return cut(left.join(sizes, "text_hash").select("key", "text_hash", "class", "n_shingles"), "near-left")


def _blocks(rows: DataFrame, held: int) -> DataFrame:
    """posting, text_hash, class: ``rows`` (key, text_hash, class, n_shingles) in postings of about ``held`` shingles at most.

    The texts of a larger posting that are outside its largest class are dealt into blocks that meet each other and the blocks of that
    class; those don't meet among themselves.
    """
    counts = rows.groupBy("key", "class").agg(F.sum("n_shingles").alias("n"))
    sizes = counts.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("main"))
    number = lambda n: F.greatest(F.lit(1), F.ceil(2 * n / held)).cast("int")
    sizes = sizes.select("key", (F.col("n") > held).alias("long"), F.col("main.class").alias("main"), number(F.col("main.n")).alias("mains"), number(F.col("n") - F.col("main.n")).alias("rests"))
    rows = rows.join(_sized(cut(sizes, "near-sizes")), "key")
    at_once = rows.where("not long").select(F.col("key").alias("posting"), "text_hash", "class")
    is_main, up_to = F.col("class") == F.col("main"), lambda n: F.sequence(F.lit(0), n - 1)
    mine = F.pmod(F.xxhash64("text_hash", F.lit(7)), F.when(is_main, F.col("mains")).otherwise(F.col("rests"))).cast("int")
    long = rows.where("long").withColumn("mine", mine)
    with_main = F.when(is_main, F.transform(up_to(F.col("rests")), lambda i: F.xxhash64("key", i, F.col("mine"), F.lit(1)))).otherwise(F.transform(up_to(F.col("mains")), lambda i: F.xxhash64("key", F.col("mine"), i, F.lit(1))))
    with_rest = F.when(is_main, F.array().cast("array<long>")).otherwise(F.transform(up_to(F.col("rests")), lambda i: F.xxhash64("key", F.least(i, F.col("mine")), F.greatest(i, F.col("mine")), F.lit(2))))
    return at_once.unionByName(long.select(F.explode(F.concat(with_main, with_rest)).alias("posting"), "text_hash", "class"))


def banded(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, text_hash, n_shingles and bands of each row, as a table."""
    rows = docs.select(F.col("doc_id").cast("long"), text_hash().alias("text_hash"), text_or_empty().alias("text"))
    return cut(rows.mapInArrow(_banded(rule), "doc_id long, text_hash long, n_shingles long, bands array<long>"), "near-bands")


def links(docs: DataFrame, rule: Rule | None = None, short: int = SHORT, held: int = HELD, rows: DataFrame | None = None) -> DataFrame:
    """a, b: hashes of texts whose links connect them as all links of the rule do; ``rows`` are those of :func:`banded`."""
    rule = rule or Rule()
    rows = banded(docs, rule) if rows is None else rows
    postings, members = _postings(rows)
    wanted = _sized(cut(members.select("text_hash").distinct(), "near-texts"))
    texts = docs.select(text_hash().alias("text_hash"), text_or_empty().alias("text"))
    few = texts.join(wanted, "text_hash", "left_semi").dropDuplicates(["text_hash"]).select("text_hash", "text")
    sets = cut(few.mapInArrow(_with_sets(rule), "text_hash long, signature binary, found array<long>"), "near-sets")
    # Texts without words have empty sets and meet in a posting of their own, which the last step searches.
    stars = cut(confirmed(_leading(postings, members), sets, rule), "near-stars")
    left = _classed(members, stars, sets.select("text_hash", F.size("found").alias("n_shingles")))
    lengths = cut(left.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("most")), "near-lengths")
    is_short = (F.col("n") <= short) & (F.col("most") > 0)
    few = left.join(_sized(lengths.where(is_short).select("key")), "key", "left_semi")
    signed = few.join(sets.select("text_hash", "signature"), "text_hash").select("key", "text_hash", "class", F.col("n_shingles").cast("long"), "signature")
    agreed = cut(signed.repartition("key").sortWithinPartitions("key").mapInArrow(_agreed(rule), "posting long, a long, b long"), "near-agreed")
    named = confirmed(agreed.where("b is not null").select("a", "b").distinct(), sets, rule)
    again = left.join(agreed.where("b is null").select(F.col("posting").alias("key"), F.col("a").alias("text_hash")), ["key", "text_hash"], "left_semi")
    long = left.join(_sized(lengths.where(~is_short).select("key")), "key", "left_semi").unionByName(again)
    gathered = cut(_blocks(cut(long, "near-long"), held), "near-blocks").join(sets.select("text_hash", "found"), "text_hash").select("posting", "text_hash", "class", "found")
    searched = gathered.repartition("posting").sortWithinPartitions("posting").mapInArrow(_searched(rule), "a long, b long")
    return stars.unionByName(named).unionByName(searched)


def keep_one(docs: DataFrame, rule: Rule | None = None, short: int = SHORT, held: int = HELD, more: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` with one row of each group of near copies, the one with the smallest doc_id; ``more`` are further links (a, b: text hashes)."""
    rows = banded(docs, rule or Rule())
    near = links(docs, rule, short, held, rows)
    found = components(near if more is None else near.unionByName(more)).select(F.col("node").alias("text_hash"), F.col("root"))
    grouped = rows.select("doc_id", "text_hash").join(found, "text_hash", "left").select("doc_id", "text_hash", F.coalesce("root", "text_hash").alias("group"))
    return keep_first(docs, grouped, BROADCAST_IDS, "near-decided")


def near_duplicates(docs: DataFrame, rule: Rule | None = None, short: int = SHORT, held: int = HELD) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept of every row."""
    rule = rule or Rule()
    rows = banded(docs, rule)
    found = components(links(docs, rule, short, held, rows)).select(F.col("node").alias("text_hash"), F.col("root"))
    texts = rows.where(F.col("n_shingles") > (-1 if rule.empty_linked else 0)).groupBy("text_hash").agg(F.min("doc_id").alias("low"))
    texts = cut(texts.join(found, "text_hash", "left").select("text_hash", "low", F.coalesce("root", "text_hash").alias("root")), "near-roots")
    least = texts.groupBy("root").agg(F.min("low").alias("component_id"))
    named = cut(texts.join(least, "root").select("text_hash", "component_id"), "near-components")
    own = rows.select("doc_id", "text_hash", "n_shingles").join(named, "text_hash", "left")
    component = F.when(F.col("n_shingles") > (-1 if rule.empty_linked else 0), F.col("component_id")).otherwise(F.col("doc_id"))
    return own.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
