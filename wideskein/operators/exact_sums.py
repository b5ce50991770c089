"""Sums of doubles that are exact, whatever the magnitudes and in whatever order and partitions rows are added.

Each value stands for one rational number. A value of at most six decimals below 10^15 (what text files hold) stands for
its decimal digits and is summed as a decimal. Any other finite value stands for itself: it is scaled to a whole number within
one of 68 bins of 32 powers of two and summed there, in two limbs. Integers alone are added, so partial sums may be
merged in any way. A column's total is the double nearest to the exact sum; infinities count as in ordinary addition.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

DECIMAL = "decimal(28,6)"
#: Powers of two in a bin, the first bin's number, and how many bins there are: 2^-1088 to 2^1088.
WIDTH, FIRST, BINS = 32, -34, 68
#: A bin's unit is this many bits below its least value.
BELOW = 54
LIMB = 40


#: Below this a value's six decimals are found by one multiplication, surely and uniquely; sums of such millionths go in three limbs.
SURE = 2.0**30
LIMB_BITS = 17


def _millionths(v: Column) -> Column:
    """A sure value in millionths, if it is a decimal of six places; else null."""
    whole = F.rint(v * 1e6)
    return F.when((F.abs(v) < SURE) & (whole / 1e6 == v), whole.cast("long"))


def _larger(v: Column) -> Column:
    """The decimal of a value that is not sure; null if it is none. Costly, so it is evaluated for such values only."""
    digits = v.try_cast(DECIMAL)
    return F.when((F.abs(v) >= SURE) & (F.abs(v) < 1e15), F.when(digits.cast("double") == v, digits))


def is_odd(v: Column) -> Column:
    """Whether a value is finite and not a decimal of six places; false for null."""
    odd = F.when(F.abs(v) < SURE, F.rint(v * 1e6) / 1e6 != v).when(F.abs(v) < float("inf"), _larger(v).isNull())
    return F.coalesce(odd, F.lit(False))


def plain_sum(v: Column) -> Column:
    """Aggregate: the sum of the decimals that values stand for, 0 without any; three sums of longs good for 2^46 rows, and one of decimals that adds little else."""
    m, mask = _millionths(v), (1 << LIMB_BITS) - 1
    parts = [F.shiftright(m, 2 * LIMB_BITS), F.shiftright(m, LIMB_BITS).bitwiseAND(F.lit(mask)), m.bitwiseAND(F.lit(mask))]
    weighed = [F.coalesce(F.sum(part), F.lit(0)).cast("decimal(20,0)") * F.lit(Decimal(2 ** (LIMB_BITS * (2 - i)))) for i, part in enumerate(parts)]
    millionths = (weighed[0] + weighed[1] + weighed[2]).cast("decimal(34,0)") * F.lit(Decimal("0.000001"))
    return (millionths.cast("decimal(38,6)") + F.coalesce(F.sum(_larger(v)), F.lit(Decimal(0)))).cast("decimal(38,6)")


def bin_of(v: Column) -> Column:
    """The bin of an odd value; null for any other."""
    return F.when(is_odd(v), F.floor(F.log2(F.abs(v)) / WIDTH).cast("int"))


def limbs(v: Column, bin_: Column) -> tuple[Column, Column]:
    """High and low part of an odd value as a whole number of its bin's units; both steps of the scaling are exact."""
    shifts = [BELOW - WIDTH * (FIRST + i) for i in range(BINS)]
    factor = lambda part: F.element_at(F.array(*(F.lit(2.0 ** part(s)) for s in shifts)), bin_ - FIRST + 1)
    scaled = F.when(is_odd(v), v) * factor(lambda s: s // 2) * factor(lambda s: s - s // 2)
    high = F.floor(scaled / 2.0**LIMB)
    low = (scaled - high.cast("double") * 2.0**LIMB).cast("long")
    return high.cast("decimal(18,0)"), low.cast("decimal(18,0)")


def beyond(v: Column) -> Column:
    """Aggregate: the sum of the infinite values; null if there are none."""
    return F.sum(F.when(F.abs(v) == float("inf"), v))


@F.pandas_udf(DoubleType())
def nearest(decimals: pd.Series, parts: pd.Series) -> pd.Series:
    """The double nearest to a decimal sum and the sums of some bins (bin, high, low): one small row of whole numbers a column."""
    from fractions import Fraction

    def one(total, bins) -> float:
        exact = Fraction(total or 0)
        for b in bins if bins is not None else ():
            exact += Fraction(int(b["high"]) * 2**LIMB + int(b["low"])) * Fraction(2) ** (WIDTH * int(b["bin"]) - BELOW)
        try:
            return exact.numerator / exact.denominator
        except OverflowError:
            return float("inf") if exact > 0 else float("-inf")

    return pd.Series([one(t, b) for t, b in zip(decimals, parts, strict=True)], dtype="float64")


def bins_of_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and bins (bin, high, low) of the odd values of (keys, value); at most 68 rows a key and task are shuffled."""
    high, low = limbs(F.col("value"), F.col("bin"))
    odd = cells.select(*keys, "value").where(is_odd(F.col("value"))).withColumn("bin", bin_of(F.col("value")))
    sums = odd.groupBy(*keys, "bin").agg(F.sum(high).alias("high"), F.sum(low).alias("low"))
    return sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("bin", "high", "low"))).alias("bins"))


def odd_cells(df: DataFrame, values: Sequence[Column]) -> DataFrame:
    """(pos, value): a row for each odd value of some columns, and for no other."""
    cells = F.array(*(F.struct(F.lit(i).alias("pos"), v.alias("value")) for i, v in enumerate(values)))
    return df.select(F.inline(F.filter(cells, lambda c: is_odd(c["value"]))))


def totals(df: DataFrame, values: Sequence[Column]) -> DataFrame:
    """pos and total of a few columns of doubles. Rows are read once, and once more if any value is odd."""
    one = lambda i, v: F.struct(F.lit(i).alias("pos"), plain_sum(v).alias("decimals"), F.count(v).alias("n"), F.count_if(is_odd(v)).alias("n_odd"), beyond(v).alias("beyond"))
    row = df.agg(*(one(i, v).alias(f"_{i}") for i, v in enumerate(values)))
    sums = row.select(F.inline(F.array(*(F.col(f"_{i}") for i in range(len(values))))))
    return with_total(sums, lambda wanted: odd_cells(df, [values[i] for i in wanted]), ["pos", "total"])


def with_total(sums: DataFrame, cells, out: Sequence[str]) -> DataFrame:
    """``sums`` (pos, decimals, n, n_odd, beyond, ...; a row a column) with the total; ``cells`` gives odd cells of the columns named, numbered as they are named."""
    schema, rows = sums.schema, sums.collect()  # a row a column of a narrow table
    known = sums.sparkSession.createDataFrame(rows, schema)
    wanted = [r.pos for r in rows if r.n_odd]
    exact = F.col("decimals").cast("double")
    if wanted:
        names = sums.sparkSession.createDataFrame(list(enumerate(wanted)), "pos int, column int")
        found = bins_of_cells(cells(wanted), ["pos"]).join(F.broadcast(names), "pos").select(F.col("column").alias("pos"), "bins")
        known, exact = known.join(F.broadcast(found), "pos", "left"), nearest("decimals", "bins")  # as many rows as columns
    total = F.when(F.col("n") > 0, F.coalesce("beyond", exact))
    return known.withColumn("total", total).select(*out)
