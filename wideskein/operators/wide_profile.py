"""Profiles of very wide rows from partial sums by position.

A task adds up whole batches of rows at once, position by position, and gives a row a position and file where
:func:`profiling.profile` over exploded cells handles one a cell. Sums are those of :mod:`exact_sums`: decimals of six places by
their digits, other values by mantissa and exponent, so both ways give the same totals.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideskein.operators import exact_sums
from wideskein.operators.profiling import merged

SURE = exact_sums.SURE
#: Values added up at a stroke, and exponents whose sums a task holds before it gives them away.
AT_ONCE, EXPONENTS = 1 << 20, 64
_MASK = (1 << 27) - 1
_PARTS = "file string, pos int, _bin int, n long, n_nan long, decimals decimal(38,6), n_odd long, beyond double, low double, high double, integral boolean, n_not_flag long, _high decimal(38,0), _low decimal(38,0)"


class Partial:
    """Sums over the rows of one file and length that a task has seen."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.n, self.n_nan, self.n_odd, self.n_not_flag = (np.zeros(width, dtype=np.int64) for _ in range(4))
        self.high_millionths, self.low_millionths = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        self.low, self.high = np.full(width, np.inf), np.full(width, -np.inf)
        self.integral = np.ones(width, dtype=bool)
        self.beyond: dict[int, float] = {}
        self.rare: dict[int, int] = {}
        self.by_exponent: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, v: np.ndarray, valid: np.ndarray) -> None:
        """Rows of values, and which of them are not null."""
        nan = np.isnan(v) & valid
        known = valid & ~nan
        self.n += known.sum(axis=0)
        self.n_nan += nan.sum(axis=0)
        self.low = np.minimum(self.low, np.where(known, v, np.inf).min(axis=0))
        self.high = np.maximum(self.high, np.where(known, v, -np.inf).max(axis=0))
        x = np.where(known, v, 0.0)
        infinite = np.isinf(x)
        self.integral &= ((x == np.floor(x)) & (infinite | (np.abs(x) < 2.0**63)) | ~known).all(axis=0) & ~infinite.any(axis=0)
        self.n_not_flag += ((x != 0) & (x != 1) & known).sum(axis=0)
        for i, j in zip(*np.nonzero(infinite), strict=True):
            self.beyond[j] = self.beyond.get(j, 0.0) + x[i, j]
        x = np.where(infinite, 0.0, x)
        sure = np.abs(x) < SURE
        millionths = np.rint(np.where(sure, x, 0.0) * 1e6)
        plain = sure & (millionths / 1e6 == x)
        whole = np.where(plain, millionths, 0.0).astype(np.int64)
        self.high_millionths += (whole >> 27).sum(axis=0)
        self.low_millionths += (whole & _MASK).sum(axis=0)
        rows, at = np.nonzero(~plain)
        if len(at):
            self._add_others(x[rows, at], at)

    def _add_others(self, v: np.ndarray, at: np.ndarray) -> None:
        odd = np.ones(len(v), dtype=bool)
        for i in np.flatnonzero((np.abs(v) >= SURE) & (np.abs(v) < 1e15)).tolist():
            digits = Decimal(repr(float(v[i]))).scaleb(6)
            near = int(digits.to_integral_value())
            if float(Decimal(near).scaleb(-6)) == v[i]:
                self.rare[int(at[i])] = self.rare.get(int(at[i]), 0) + near
                odd[i] = False
        v, at = v[odd], at[odd]
        self.n_odd += np.bincount(at, minlength=self.width)
        share, exponent = np.frexp(v)
        mantissa, unit = (share * 2.0**53).astype(np.int64), exponent - 53
        for e in np.unique(unit).tolist():
            here = unit == e
            sums = self.by_exponent.setdefault(e, (np.zeros(self.width, dtype=np.int64), np.zeros(self.width, dtype=np.int64)))
            for total, part in zip(sums, (mantissa[here] >> 27, mantissa[here] & _MASK), strict=True):
                np.add.at(total, at[here], part)

    def bins(self, file: str | None) -> Iterator[tuple]:
        """Rows of the exponents' sums in bins of :mod:`exact_sums`; they are forgotten here."""
        found: dict[tuple[int, int], int] = {}
        for e, (high, low) in self.by_exponent.items():
            number = (e + exact_sums.BELOW) // exact_sums.WIDTH
            shift = e + exact_sums.BELOW - exact_sums.WIDTH * number
            for j in np.flatnonzero(high | low).tolist():
                found[j, number] = found.get((j, number), 0) + (((int(high[j]) << 27) + int(low[j])) << shift)
        self.by_exponent = {}
        for (j, number), total in found.items():
            yield (file, j, number, 0, 0, None, 0, None, None, None, None, 0, Decimal(total >> exact_sums.LIMB), Decimal(total & ((1 << exact_sums.LIMB) - 1)))

    def rows(self, file: str | None) -> Iterator[tuple]:
        for j in range(self.width):
            some = bool(self.n[j])
            millionths = (int(self.high_millionths[j]) << 27) + int(self.low_millionths[j]) + self.rare.get(j, 0)
            yield (
                file, j, None, int(self.n[j]), int(self.n_nan[j]), Decimal(millionths).scaleb(-6) if some else None, int(self.n_odd[j]), self.beyond.get(j),
                float(self.low[j]) if some else None, float(self.high[j]) if some else None, bool(self.integral[j]) if some else None, int(self.n_not_flag[j]), None, None,
            )
        yield from self.bins(file)


_SCHEMA = pa.schema([
    ("file", pa.string()), ("pos", pa.int32()), ("_bin", pa.int32()), ("n", pa.int64()), ("n_nan", pa.int64()), ("decimals", pa.decimal128(38, 6)), ("n_odd", pa.int64()), ("beyond", pa.float64()),
    ("low", pa.float64()), ("high", pa.float64()), ("integral", pa.bool_()), ("n_not_flag", pa.int64()), ("_high", pa.decimal128(38, 0)), ("_low", pa.decimal128(38, 0)),
])


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 4096:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def _partials(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (file, values): partial sums a file and position. A file whose rows change their length is given away each time they do."""
    at, partial = None, None
    for batch in batches:
        files, lists = batch.column(0).to_pylist(), batch.column(1)
        ends = lists.offsets.to_numpy()
        values = lists.values
        flat, valid = values.to_numpy(zero_copy_only=False), values.is_valid().to_numpy(zero_copy_only=False)
        lengths = np.diff(ends).tolist()
        i = 0
        while i < len(files):
            j = i + 1
            while j < len(files) and (files[j], lengths[j]) == (files[i], lengths[i]) and (j - i) * lengths[i] < AT_ONCE:
                j += 1
            if (files[i], lengths[i]) != at:
                if partial is not None:
                    yield from _batches(partial.rows(at[0]))
                at, partial = (files[i], lengths[i]), Partial(lengths[i])
            if lengths[i]:
                part = slice(ends[i], ends[j])
                partial.add(flat[part].reshape(j - i, lengths[i]), valid[part].reshape(j - i, lengths[i]))
            if len(partial.by_exponent) > EXPONENTS:
                yield from _batches(partial.bins(at[0]))
            i = j
    if partial is not None:
        yield from _batches(partial.rows(at[0]))


def profile_wide(rows: DataFrame, keys: tuple[str, ...] = ("pos",)) -> DataFrame:
    """The profile of (file, values) rows by position, or by ``file`` and ``pos``: what :func:`profiling.profile` gives for their cells.

    A task gives about a row a position of each file it reads, however many rows those have. A null row has no values; a
    null value is in no count.
    """
    parts = rows.select(F.col("file").cast("string"), F.coalesce(F.col("values").cast("array<double>"), F.array().cast("array<double>")).alias("values")).mapInArrow(_partials, _PARTS)
    return merged(parts, list(keys))
