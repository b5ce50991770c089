"""Packing documents into sequences by cutting-stock column generation.

A document's ids fill whole sequences as far as they go; the remainder, shorter than a sequence, is an item
of the cutting-stock problem. Items are counted in a histogram of length classes (lengths rounded up to
``GRAIN`` tokens). A linear program over patterns (how many items of each class one sequence takes) is solved
by column generation: the simplex duals price the classes and a knapsack dynamic program finds the pattern
worth most. The solution is rounded down, what is left of the histogram is packed by first fit decreasing,
and patterns are handed to the documents of each class by rank. All of that works on the histogram, whose
size depends on the sequence length alone; documents are tokenised, ranked and placed by Spark.

Defined cases. A null text counts as empty; every document has the end id and so at least one token. Repeated
rows are packed as separate documents; equal rows are interchangeable. An empty table gives an empty result.
Very long texts are tokenised in whole. Extra columns are ignored.
"""

from __future__ import annotations

import re
import warnings
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wideskein.llm.common import bucket_count, cut, gapless_position, slices, text_or_empty

CAPACITY = 4096
END_ID = 2
GRAIN = 8
VOCABULARY = "word_bpe_49k.json"
#: Pivots after which the basis is inverted anew.
REFRESH = 1000
#: Words and parts of words whose ids a Python worker keeps.
_WORD_MEMO = 100_000
_UNIT_MEMO = 60_000


#: Characters on which the splitter below and the vocabulary's agree for certain, and their lower-case splitter.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_UNITS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> list[str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others as letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(0x100 + len(letters) - len(plain)))
    return [letters[b] for b in range(256)]


_LETTERS = {b: c for b, c in enumerate(_byte_letters())}


class WordIds:
    """Ids of texts, looked up by word, as little-endian bytes.

    The vocabulary's normaliser and splitter never join characters across ASCII white space, so the ids of a
    text are those of its white-space words in order. A word of plain characters is split further, as the
    vocabulary does, and its parts go to the vocabulary's model; other words go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.units: dict[str, bytes] = {}

    def _unit(self, unit: str) -> bytes:
        letters = unit if unit.isascii() else unit.encode().decode("latin-1").translate(_LETTERS)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])

    def _learn(self, missing: set[bytes]) -> dict[bytes, bytes]:
        found: dict[bytes, bytes] = {}
        known, room = self.units, _UNIT_MEMO - len(self.units)
        for raw in missing:
            word = raw.decode("utf-8", "replace")
            if "<|" in word or not _PLAIN.fullmatch(word):
                found[raw] = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
                continue
            parts = []
            for unit in _UNITS.findall(word.lower()):
                ids = known.get(unit)
                if ids is None:
                    ids = self._unit(unit)
                    if room > 0:
                        known[unit] = ids
                        room -= 1
                parts.append(ids)
            found[raw] = b"".join(parts)
        return found

    def __call__(self, texts: Sequence[str]) -> list[np.ndarray]:
        split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        known = self.words
        parts = [list(map(known.get, s)) for s in split]
        short = [i for i, p in enumerate(parts) if None in p]
        missing = {w for i in short for w, ids in zip(split[i], parts[i], strict=True) if ids is None}
        found = self._learn(missing) if missing else {}
        for i in short:
            parts[i] = [found[w] if ids is None else ids for w, ids in zip(split[i], parts[i], strict=True)]
        if len(known) < _WORD_MEMO:
            known |= found
        elif len(missing) > 0.3 * sum(map(len, split)):  # another kind of text: learn anew
            self.words, self.units = {}, {}
        return [np.frombuffer(b"".join(p), dtype="<u4") for p in parts]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: each document cut at every ``capacity`` ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _word_ids(path)
        for batch in slices(batches):
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), ids_of(batch.column(1).to_pylist()), strict=True):
                whole = np.append(ids, np.array([end_id], dtype="<u4"))
                for start in range(0, len(whole), capacity):
                    part = whole[start : start + capacity]
                    out.append((doc_id, start, len(part), zlib.crc32(part.tobytes()), len(whole)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def best_patterns(values: np.ndarray, sizes: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming over room: items of ascending ``sizes`` worth ``values``.

    The worth of the best pattern, and for every class the best pattern that holds it, best first (rows).
    """
    worth, chosen = np.zeros(units + 1), np.full(units + 1, -1)
    fits = np.searchsorted(sizes, np.arange(units + 1), side="right").tolist()
    for room in range(1, units + 1):
        worth[room] = worth[room - 1]
        k = fits[room]
        if k:
            totals = values[:k] + worth[room - sizes[:k]]
            i = int(totals.argmax())
            if totals[i] > worth[room] + 1e-12:
                worth[room], chosen[room] = totals[i], i
    order = np.argsort(-(values + worth[units - sizes]), kind="stable")
    patterns, room = np.zeros((len(sizes), len(sizes)), dtype=np.int64), units - sizes[order]
    patterns[np.arange(len(order)), order] = 1
    open_rows = np.flatnonzero(room > 0)
    while len(open_rows):
        item = chosen[room[open_rows]]
        taken = item >= 0
        patterns[open_rows[taken], item[taken]] += 1
        room[open_rows] -= np.where(taken, sizes[np.maximum(item, 0)], 1)
        open_rows = open_rows[room[open_rows] > 0]
    return float(worth[units]), patterns


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By elimination with pivoting, in plain array operations: linear algebra libraries start threads, which the driver must not wait for."""
    m = len(matrix)
    both = np.hstack([matrix, np.eye(m)])
    for i in range(m):
        pivot = i + int(np.abs(both[i:, i]).argmax())
        if pivot != i:
            both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i]
        factors = both[:, i].copy()
        factors[i] = 0.0
        rows = np.flatnonzero(factors)
        both[rows] -= factors[rows, None] * both[i]
    return both[:, m:]


def filled_in_turn(demand: np.ndarray, sizes: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """A basis to start from, and its amounts: sequences filled with the largest classes left, each pattern as often as the first class it uses up allows.

    A pattern holds no class used up before, so that the basis is triangular.
    """
    m, left = len(demand), demand.astype(np.float64)
    basis, x = np.zeros((m, m)), np.zeros(m)
    open_classes = np.flatnonzero(left > 0)[::-1].tolist()
    for i in np.flatnonzero(left <= 0):
        basis[i, i] = units // sizes[i]
    while open_classes:
        room, column = units, np.zeros(m)
        for i in open_classes:
            column[i] = room // sizes[i]
            room -= int(column[i]) * int(sizes[i])
            if not room:
                break
        held = np.flatnonzero(column)
        ratios = left[held] / column[held]
        first = int(held[ratios.argmin()])
        x[first] = ratios.min()
        left[held] = np.maximum(left[held] - x[first] * column[held], 0.0)
        basis[:, first] = column
        open_classes.remove(first)
    return basis, x


def generate_columns(demand: np.ndarray, sizes: np.ndarray, units: int, most_steps: int = 20_000, gap: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one a column) and their amounts: the linear program min sum(x), patterns . x >= demand, by revised simplex.

    The duals of the basis price the classes; the knapsack gives the patterns worth more than 1, and pivots go on
    among those known until none is worth more. It ends when the solution is within ``gap`` of a lower bound: what
    the items fill, or the solution divided by the worth of the best pattern. Should it need more than ``most_steps``
    pivots, the patterns found so far are used, with a warning; they pack everything too.
    """
    m = len(demand)
    basis, x = filled_in_turn(demand, sizes, units)
    inverse = _inverse(basis)
    slack = np.zeros(m, dtype=bool)  # basis columns that are surplus of a class, at no cost
    pool = np.zeros((0, m))
    steps, since, filled = 0, 0, float((demand * sizes).sum()) / units
    while steps < most_steps and x[~slack].sum() > (1.0 + gap) * filled:
        duals = inverse[~slack].sum(axis=0)
        worth, found = best_patterns(np.maximum(duals, 0.0), sizes, units)
        negative = duals.min() < -1e-9
        if worth <= 1.0 + gap and not negative:
            break
        pool = np.vstack([pool[-2 * m :], found.astype(np.float64)])
        moved = False
        while steps < most_steps and x[~slack].sum() > (1.0 + gap) * filled:
            duals = inverse[~slack].sum(axis=0)
            lowest = int(duals.argmin())
            if duals[lowest] < -1e-9:
                entering, is_slack = np.zeros(m), True
                entering[lowest] = -1.0
            else:
                prices = (pool * duals).sum(axis=1)
                best = int(prices.argmax())
                if prices[best] <= 1.0 + gap / 2:
                    break
                entering, is_slack = pool[best], False
            held = np.flatnonzero(entering)
            direction = (inverse[:, held] * entering[held]).sum(axis=1)
            ratios = np.full(m, np.inf)
            np.divide(x, direction, out=ratios, where=direction > 1e-9)
            leaving = int(ratios.argmin())
            if not np.isfinite(ratios[leaving]):
                break
            theta = ratios[leaving]
            x = np.maximum(x - theta * direction, 0.0)
            x[leaving] = theta
            basis[:, leaving] = entering
            slack[leaving] = is_slack
            row = inverse[leaving] / direction[leaving]
            rows = np.flatnonzero(direction)
            inverse[rows] -= direction[rows, None] * row
            inverse[leaving] = row
            steps, since, moved = steps + 1, since + 1, True
            if since == REFRESH:
                inverse, since = _inverse(basis), 0
                x = np.maximum((inverse * demand).sum(axis=1), 0.0)
        if not moved:
            break
    if steps >= most_steps:
        warnings.warn(f"column generation ended after {most_steps} pivots; the best pattern was worth {worth:.4f}", stacklevel=2)
    keep = ~slack & (x > 1e-9)
    return basis[:, keep].astype(np.int64), x[keep]


def plan(histogram: Sequence[int], units: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """(times, ((class, count), ...)) of every pattern used; each class's items are used exactly. Class i takes i + 1 units."""
    left = np.array(histogram, dtype=np.int64)
    used: Counter = Counter()
    if left.any():
        present = np.flatnonzero(left)
        columns, amounts = generate_columns(left[present].astype(np.float64), present + 1, units)
        for j in np.argsort(-amounts, kind="stable"):
            times = int(amounts[j] + 1e-6)
            column = columns[:, j]
            held = np.flatnonzero(column)
            times = min(times, int((left[present[held]] // column[held]).min()))
            if times > 0:
                left[present[held]] -= times * column[held]
                used[tuple((int(present[i]), int(column[i])) for i in held)] += times
    rooms: list[int] = []
    filled: list[Counter] = []
    for i in np.flatnonzero(left)[::-1]:
        size, number = int(i) + 1, int(left[i])
        for b in range(len(rooms)):
            take = min(number, rooms[b] // size)
            if take:
                rooms[b] -= take * size
                filled[b][int(i)] += take
                number -= take
        while number:
            take = min(number, units // size)
            rooms.append(units - take * size)
            filled.append(Counter({int(i): take}))
            number -= take
    for content in filled:
        used[tuple(sorted(content.items()))] += 1
    return [(times, pattern) for pattern, times in sorted(used.items(), key=lambda p: (-p[1], p[0]))]


def pack(rows: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """``rows`` of :func:`pieces` (a written table) with sequence_id and offset.

    Whole sequences come first, in gapless order; then the patterns', each ``times`` sequences long.
    """
    spark = rows.sparkSession
    grain = grain if capacity % grain == 0 else 1
    units = capacity // grain
    classed = rows.withColumn("class", F.expr(f"cast((length - 1) div {grain} as int)"))
    counts = {r["class"]: r.n for r in classed.where(F.col("length") < capacity).groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = rows.where(F.col("length") == capacity).count()
    histogram = [counts.get(i, 0) for i in range(units)]
    slots, first = [], whole
    given = [0] * units
    for times, pattern in plan(histogram, units):
        for i, each in pattern:
            slots.append((i, given[i], given[i] + times * each, each, first))
            given[i] += times * each
        first += times
    order = ["doc_id", "start", "length", "ids_crc32"]
    full = classed.where(F.col("length") == capacity).withColumn("class", F.lit(0))
    full = gapless_position(full, "class", order, "sequence_id", bucket_count(whole)).withColumn("offset", F.lit(0).cast("long"))
    sizes = spark.createDataFrame([(i, n) for i, n in enumerate(histogram) if n] or [(-1, 0)], "class int, rows long")
    part = classed.where(F.col("length") < capacity).join(F.broadcast(sizes), "class")  # a row per class
    part = gapless_position(part, "class", order, "rank", bucket_count(F.col("rows")))
    table = spark.createDataFrame(slots or [(-1, 0, 0, 1, 0)], "class int, low long, high long, each long, first long")
    # The table has at most a few patterns per class, whatever the number of documents.
    placed = part.join(F.broadcast(table), "class").where("rank >= low and rank < high").withColumn("sequence_id", F.expr("first + (rank - low) div each"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return full.select(*names).unionByName(placed.select(*names))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document: where its ids come from and where they go."""
    return pack(cut(pieces(docs, path or vocabulary_path(), capacity, end_id), "pack-pieces"), capacity)


def sequences(docs: DataFrame, packed: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """sequence_id and its ids, the pieces of ``packed`` filled from ``docs`` (doc_id unique) in order of offset."""
    path = path or vocabulary_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _word_ids(path)
        for batch in slices(batches, 64):
            ids = ids_of(batch.column(1).to_pylist())
            cuts = batch.column(0).to_pylist()
            flat = [(c["sequence_id"], c["offset"], np.append(i, np.uint32(end_id))[c["start"] : c["start"] + c["length"]].astype(np.int32)) for each, i in zip(cuts, ids, strict=True) for c in each]
            columns = list(zip(*flat, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.list_(pa.int32()))], names=["sequence_id", "offset", "ids"])

    cuts = packed.groupBy("doc_id").agg(F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("cuts"))
    parts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).join(cuts, "doc_id").select("cuts", "text")
    placed = parts.mapInArrow(run, "sequence_id long, offset long, ids array<int>")
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
