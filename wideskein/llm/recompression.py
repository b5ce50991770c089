"""Substring dedup by recompression: rounds name runs and pairs of words, shared interior symbols reveal and verify long repeats.

In every round a document's sequence of symbols is compressed: maximal runs of one symbol become one symbol, then
every left symbol and the right symbol after it become one. A symbol is named by the words it stands for and the
name decides left or right, so the rounds name alike in all documents and equal passages hold equal symbols inside,
all but near their ends. What a name is shared by is found by a Spark aggregation over all documents, from the
highest symbols down; windows of words decide.

1. High symbols. After ``HIGH_ROUNDS`` rounds a symbol spans about ten words. Of every three in a row that a smaller
   doc_id has too, only the windows that tile them go on: they cover the same words as all windows in there.
2. Low symbols. A symbol is known to be the same wherever the words that decided it are the same (itself, and what
   the rounds looked at beside it). Each window that goes on is represented by the highest symbol that its own words
   decide, of those the one whose deciding words hash least, and by all its words if it decides none. Windows share
   representatives: there is about one for four words. Only those that several documents have go on.
3. Windows of shared representatives are compared by two 64-bit hashes of all their words, of different bases, and the
   smallest document of each is found by map-side minima. (Comparing the words themselves gave the same results, but
   took more disk than the check tool allows: 4.2 to 4.5 x input.)

Shared triples and names are sent to the texts by broadcast, up to ``BROADCAST_TRIPLES`` and ``BROADCAST_NAMES`` of
them. Beyond that they are gathered by text and joined with the texts by a shuffle; the steps are the same.

Defined cases. A null text has no words and keeps the empty string; a text shorter than a window keeps all its
words. A document with null doc_id is neither changed nor evidence. Repeated rows (same doc_id) are not evidence
against each other. Rows that share a doc_id but not the text are told apart by a hash of the text. An empty
table gives an empty result. Extra columns pass through :func:`remove_repeats` (names beginning with ``_cut_``
are reserved) and are ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest as digest

from wideskein.llm.common import cut, slices
from wideskein.llm.sketches import mix

WINDOW = 13
HIGH_ROUNDS = 8
LOW_ROUNDS = 2
BROADCAST_TRIPLES = 2_000_000
BROADCAST_NAMES = 4_000_000
BROADCAST_RANGES = 2_000_000

#: Odd bases of the two hashes of word sequences, and what makes sides differ from round to round.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SIDES = 0xD6E8FEB86659FD93
_MOST = np.iinfo(np.uint64).max


class Spans:
    """Hashes of any run of words of a batch, from prefix sums: sum of word i times base^i, divided by base^first."""

    def __init__(self, words: np.ndarray, base: int) -> None:
        n = len(words) + 1
        self.down = self._powers(pow(base, -1, 2**64), n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self._powers(base, n)[:-1], dtype=np.uint64)])

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def __call__(self, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        return mix((self.sums[after] - self.sums[first]) * self.down[first] + (after - first).astype(np.uint64))


@dataclass
class Decided:
    """Symbols made in one round, in order, and the words that decided each: from ``low`` up to ``high``."""

    low: np.ndarray
    high: np.ndarray


class Batch:
    """Hashed words of some texts, and what the rounds make of them."""

    def __init__(self, texts: list[str]) -> None:
        split = [_words(t) for t in texts]
        self.counts = np.array([len(w) for w in split], dtype=np.int64)
        self.ends = np.cumsum(self.counts)
        self.firsts = self.ends - self.counts
        self.words = np.frombuffer(b"".join([digest(w) for s in split for w in s]), dtype=">u8").astype(np.uint64)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.spans = Spans(self.words, _BASES[0])

    def _after(self, start: np.ndarray) -> np.ndarray:
        return np.append(start[1:], len(self.words))

    def _runs(self, start: np.ndarray) -> np.ndarray:
        """Which symbols begin a maximal run (of one symbol or more)."""
        name, doc = self.spans(start, self._after(start)), self.doc[start]
        heads = np.ones(len(start), dtype=bool)
        heads[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        return heads

    def _pairs(self, start: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Which symbols are left ones, and the places of those that a right one follows."""
        name, doc = self.spans(start, self._after(start)), self.doc[start]
        left = mix(name ^ np.uint64(_SIDES * (level + 1) % 2**64)) & np.uint64(1) == 0
        return left, np.flatnonzero(left[:-1] & ~left[1:] & (doc[:-1] == doc[1:]))

    def high(self, rounds: int = HIGH_ROUNDS) -> np.ndarray:
        """First words of the symbols after that many rounds."""
        start = np.arange(len(self.words))
        for level in range(rounds):
            start = start[self._runs(start)]
            keep = np.ones(len(start), dtype=bool)
            keep[self._pairs(start, level)[1] + 1] = False
            start = start[keep]
        return start

    def low(self, rounds: int = LOW_ROUNDS) -> list[Decided]:
        """The symbols that each round makes and that words of their own document decide, lowest round first.

        A symbol after run naming depends on the symbols on either side, which end the run; one that found no
        partner also depends on the symbol that could have been it. What the edge of a document had part in
        is left out.
        """
        n, far = len(self.words), 2 * len(self.words) + 2
        start = np.arange(n)
        low, high = start, start + 1
        made = []
        for level in range(rounds):
            if not len(start):
                break
            heads = np.flatnonzero(self._runs(start))
            last = np.append(heads[1:], len(start)) - 1
            long = last > heads
            start, before, behind = start[heads], low[heads - 1], high[np.minimum(last + 1, len(high) - 1)]
            opens = np.ones(len(start), dtype=bool)
            opens[1:] = self.doc[start[1:]] != self.doc[start[:-1]]
            closes = np.append(opens[1:], True)
            low, high = np.where(opens, -1, before), np.where(closes, far, behind)
            left, first = self._pairs(start, level)
            paired_low, paired_high = low[first], high[first + 1]
            behind, before = np.where(closes, far, np.append(high[1:], far)), np.where(opens, -1, np.append(-1, low[:-1]))
            low, high = np.where(left, low, before), np.where(left, behind, high)
            low[first], high[first] = paired_low, paired_high
            long[first] = True
            keep = np.ones(len(start), dtype=bool)
            keep[first + 1] = False
            start, low, high, new = start[keep], low[keep], high[keep], long[keep]
            known = new & (low >= 0) & (high <= n)
            made.append(Decided(low[known], high[known]))
        return made

    def triples(self, least: int) -> tuple[np.ndarray, ...]:
        """Place, first word and word after the last of every three high symbols in a row with ``least`` words at least."""
        start = self.high()
        if len(start) < 3:
            return (np.empty(0, np.int64),) * 3
        after = self._after(start)[2:]
        same = (self.doc[start[:-2]] == self.doc[start[2:]]) & (after - start[:-2] >= least)
        return np.flatnonzero(same), start[:-2][same], after[same]

    def windows(self, width: int) -> np.ndarray:
        n = max(0, len(self.words) - width + 1)
        return np.flatnonzero(self.doc[:n] == self.doc[len(self.doc) - n :])

    def representatives(self, starts: np.ndarray, width: int) -> np.ndarray:
        """The name that stands for each of the windows at ``starts``."""
        names = np.empty(len(starts), dtype=np.uint64)
        left = np.arange(len(starts))
        for symbols in reversed(self.low()):
            fit = symbols.high - symbols.low <= width
            low, high = symbols.low[fit], symbols.high[fit]
            hashed = self.spans(low, high)
            at = starts[left]
            one, past = np.searchsorted(low, at), np.searchsorted(high, at + width, side="right")
            some = past > one
            one, past = one[some], past[some]
            best = hashed[one]
            for k in range(1, int((past - one).max(initial=0))):
                more = np.flatnonzero(one + k < past)
                best[more] = np.minimum(best[more], hashed[one[more] + k])
            names[left[some]] = best
            left = left[~some]
        names[left] = self.spans(starts[left], starts[left] + width)
        return names


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


class Triples:
    """Triples of high symbols that several documents have, with the smallest doc_id of each."""

    def __init__(self, name: np.ndarray, check: np.ndarray, low: np.ndarray) -> None:
        order = np.argsort(name, kind="stable")
        self.name, self.check, self.low = name[order], check[order], low[order]

    def windows(self, batch: Batch, ids: np.ndarray, width: int) -> np.ndarray:
        """Starts of the windows that go on: those in no triple that a smaller doc_id has, and the tiles of such triples."""
        starts = batch.windows(width)
        place, first, after = batch.triples(width)
        if not len(place) or not len(self.name):
            return starts
        name, check = batch.spans(first, after), Spans(batch.words, _BASES[1])(first, after)
        at = np.minimum(np.searchsorted(self.name, name), len(self.name) - 1)
        hit = np.flatnonzero((self.name[at] == name) & (self.check[at] == check) & (self.low[at] < ids[batch.doc[first]]))
        if not len(hit):
            return starts
        place, first, after = place[hit], first[hit], after[hit]
        step = np.zeros(len(batch.words) + 2, dtype=np.int64)
        np.add.at(step, first, 1)
        np.add.at(step, after - width + 1, -1)
        go = np.cumsum(step)[: len(batch.words)] == 0
        # Of triples in a row every third and the last hold all the words.
        opens = np.append(True, np.diff(place) != 1)
        in_row = place - np.maximum.accumulate(np.where(opens, place, 0))
        chosen = (in_row % 3 == 0) | np.append(opens[1:], True)
        first, after = first[chosen], after[chosen]
        tiles = (after - first) // width
        nth = np.arange(tiles.sum()) - np.repeat(np.cumsum(tiles) - tiles, tiles)
        go[np.repeat(first, tiles) + width * nth] = True
        go[after - width] = True
        return starts[go[starts]]


def _distinct(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Places of one of each (doc, keys...)."""
    order = np.lexsort((*keys, doc))
    fresh = np.ones(len(order), dtype=bool)
    if len(order):
        fresh[1:] = np.any([k[order][1:] != k[order][:-1] for k in (doc, *keys)], axis=0)
    return order[fresh]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string"))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _unsigned(x: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return x.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


@dataclass
class Sent:
    """What reaches the texts: by broadcast, or as columns of lists if there is too much."""

    rows: DataFrame
    value: Callable[[pa.RecordBatch], object]


def _send(rows: DataFrame, found: DataFrame, occurrences: DataFrame, column: str, most: int, build: Callable[[list[np.ndarray]], object]) -> Sent:
    """``rows`` (with text_hash) and the way from a batch of them to ``build`` of ``found``'s columns that its texts hold.

    ``occurrences`` names, by the columns it shares with ``found``, what each text_hash holds. Lists of a batch are
    put together: they say the same of all texts.
    """
    names = found.columns
    if found.count() <= most:
        table = found.toArrow()
        held = rows.sparkSession.sparkContext.broadcast(build([table[c].to_numpy().astype(np.int64) for c in names]))
        return Sent(rows, lambda batch: held.value)
    keys = [c for c in names if c in occurrences.columns]
    lists = occurrences.join(found, keys).groupBy("text_hash").agg(F.collect_set(F.struct(*names)).alias(column))

    def gathered(batch: pa.RecordBatch):
        flat = batch.column(batch.schema.get_field_index(column)).flatten()
        return build([flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names])

    return Sent(rows.join(cut(lists, f"repeat-{column}"), "text_hash", "left"), gathered)


def triple_names(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """name, check, doc_id, text_hash: each triple of high symbols of a document once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            b = Batch(batch.column(2).to_pylist())
            _, first, after = b.triples(window)
            name, check, doc = b.spans(first, after), Spans(b.words, _BASES[1])(first, after), b.doc[first]
            one = _distinct(doc, name)
            rows = pa.array(doc[one])
            yield pa.RecordBatch.from_arrays([_signed(name[one]), _signed(check[one]), batch.column(0).take(rows), batch.column(1).take(rows)], names=["name", "check", "doc_id", "text_hash"])

    return _keyed(docs).mapInArrow(run, "name long, check long, doc_id long, text_hash long")


def symbol_names(sent: Sent, window: int = WINDOW) -> DataFrame:
    """name, doc_id, text_hash: each representative of a document's windows once."""
    known = sent.value

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            b = Batch(batch.column(2).to_pylist())
            starts = known(batch).windows(b, batch.column(0).to_numpy(), window)
            name, doc = b.representatives(starts, window), b.doc[starts]
            one = _distinct(doc, name)
            rows = pa.array(doc[one])
            yield pa.RecordBatch.from_arrays([_signed(name[one]), batch.column(0).take(rows), batch.column(1).take(rows)], names=["name", "doc_id", "text_hash"])

    columns = ["doc_id", "text_hash", "text", *(c for c in sent.rows.columns if c not in ("doc_id", "text_hash", "text"))]
    return sent.rows.select(*columns).mapInArrow(run, "name long, doc_id long, text_hash long")


def shared_windows(sent: Sent, named: Sent, window: int = WINDOW) -> DataFrame:
    """w1, w2 (two hashes of all its words), starts, doc_id, text_hash: each window of shared representative once a document, and where it begins there."""
    known, shared = sent.value, named.value

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            b = Batch(batch.column(2).to_pylist())
            starts = known(batch).windows(b, batch.column(0).to_numpy(), window)
            name, names = b.representatives(starts, window), shared(batch)
            hit = names[np.minimum(np.searchsorted(names, name), len(names) - 1)] == name if len(names) else np.zeros(len(name), dtype=bool)
            starts = starts[hit]
            one, two, doc = b.spans(starts, starts + window), Spans(b.words, _BASES[1])(starts, starts + window), b.doc[starts]
            order = np.lexsort((starts, two, one, doc))
            one, two, doc, starts = one[order], two[order], doc[order], starts[order]
            heads = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (doc[1:] != doc[:-1]))[: len(starts)])
            rows = pa.array(doc[heads])
            lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(starts)).astype(np.int32)), pa.array((starts - b.firsts[doc]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([_signed(one[heads]), _signed(two[heads]), lists, batch.column(0).take(rows), batch.column(1).take(rows)], names=["w1", "w2", "starts", "doc_id", "text_hash"])

    rows = named.rows.select("doc_id", "text_hash", "text", *(c for c in named.rows.columns if c not in ("doc_id", "text_hash", "text")))
    return rows.mapInArrow(run, "w1 long, w2 long, starts array<int>, doc_id long, text_hash long")


def repeated_windows(docs: DataFrame, window: int = WINDOW, broadcast_triples: int = BROADCAST_TRIPLES, broadcast_names: int = BROADCAST_NAMES) -> DataFrame:
    """doc_id, text_hash, starts of windows that also start in a smaller doc_id; together they hold every word that such windows cover."""
    ends = lambda named, *keys: named.groupBy(*keys).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    triples = triple_names(docs, window)
    found = cut(ends(triples, "name", "check").select("name", "check", "low"), "repeat-triples")
    sent = _send(_keyed(docs), found, triples.select("name", "check", "text_hash"), "triples", broadcast_triples, lambda c: Triples(c[0].view(np.uint64), c[1].view(np.uint64), c[2]))
    symbols = symbol_names(sent, window)
    names = cut(ends(symbols, "name").select("name"), "repeat-names")
    named = _send(sent.rows, names, symbols.select("name", "text_hash"), "names", broadcast_names, lambda c: np.unique(c[0].view(np.uint64)))
    windows = cut(shared_windows(sent, named, window), "repeat-windows")
    # As a table of its own it leaves the join two plain shuffles, whose large partitions Spark splits.
    least = cut(ends(windows, "w1", "w2").select("w1", "w2", "low"), "repeat-least")
    return windows.join(least, ["w1", "w2"]).where("low < doc_id").select("doc_id", "text_hash", "starts")


def repeated_ranges(docs: DataFrame, window: int = WINDOW, **limits: int) -> DataFrame:
    """doc_id, text_hash and ranges (array of first word, word after the last) of what is covered by repeats, per document that has any."""
    schema = "doc_id long, text_hash long, ranges array<struct<first:int,after:int>>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            out = []
            for starts in batch.column(2):
                start = np.unique(starts.values.to_numpy().astype(np.int64))
                opens = np.append(True, np.diff(start) > window)
                closes = np.append(opens[1:], True)
                out.append([{"first": int(a), "after": int(b) + window} for a, b in zip(start[opens], start[closes], strict=True)])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], names=["doc_id", "text_hash", "ranges"])

    starts = repeated_windows(docs, window, **limits).groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return starts.mapInArrow(run, schema)


def _with_ranges(docs: DataFrame, window: int, broadcast_ranges: int = BROADCAST_RANGES, **limits: int) -> DataFrame:
    """``docs`` with _cut_ranges, null where nothing repeats."""
    ranges = cut(repeated_ranges(docs, window, **limits), "repeat-ranges").withColumnsRenamed({"doc_id": "_cut_id", "text_hash": "_cut_hash", "ranges": "_cut_ranges"})
    if ranges.agg(F.coalesce(F.sum(F.size("_cut_ranges")), F.lit(0))).first()[0] <= broadcast_ranges:
        ranges = F.broadcast(ranges)
    return docs.join(ranges, (F.col("doc_id") == F.col("_cut_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_cut_hash")), "left").drop("_cut_id", "_cut_hash")


def _kept(text: str | None, ranges: list[dict] | None) -> tuple[int, int, bytes]:
    words = _words(text or "")
    if not ranges:
        return len(words), 0, b" ".join(words)
    kept, at = [], 0
    for r in ranges:
        kept.extend(words[at : r["first"]])
        at = r["after"]
    kept.extend(words[at:])
    return len(words), len(words) - len(kept), b" ".join(kept)


def kept_digests(docs: DataFrame, window: int = WINDOW, **limits: int) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document; ``limits`` are the broadcast_ ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [_kept(t, r) for t, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [batch.column(0), pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.int64()), pa.array([hashlib.sha256(m[2]).hexdigest() for m in made], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = _with_ranges(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), window, **limits)
    return rows.select("doc_id", "text", "_cut_ranges").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, **limits: int) -> DataFrame:
    """``docs`` with the repeated words taken out of text; texts without repeats are unchanged."""

    @F.pandas_udf("string")
    def cleaned(text, ranges):
        return text.combine(ranges, lambda t, r: t if r is None else _kept(t, list(r))[2].decode("utf-8", "surrogatepass"))

    rows = _with_ranges(docs, window, **limits)
    return rows.withColumn("text", cleaned(F.col("text").cast("string"), "_cut_ranges")).select(*(F.col(f"`{c}`") for c in docs.columns))
