"""Column profiles, classes and content fingerprints, for column tables and for wide array rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideskein.functions.scalars import byte_or_null, decimal_text, is_integral
from wideskein.operators import exact_sums


def long_form(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, pos, name, value): one row per cell, from one scan."""
    cells = F.array(*(F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)))
    return df.select(*keys, F.inline(cells))


def wide_form(rows: DataFrame) -> DataFrame:
    """(file, pos, value) of array rows; partial aggregation shrinks it before any shuffle."""
    return rows.select("file", F.posexplode("values").alias("pos", "value"))


def profile_columns(value: Column | None = None) -> list[Column]:
    """Aggregates of one column; ``decimals`` is the sum of those values that are decimals of six places, ``n_odd`` counts the others."""
    value = F.col("value") if value is None else value
    v = F.when(~F.isnan(value), value)
    return [
        F.count(v).alias("n"),
        F.count_if(F.isnan(value)).alias("n_nan"),
        exact_sums.plain_sum(v).alias("decimals"),
        F.count_if(exact_sums.is_odd(v)).alias("n_odd"),
        exact_sums.beyond(v).alias("beyond"),
        F.min(v).alias("low"),
        F.max(v).alias("high"),
        F.bool_and(is_integral(v)).alias("integral"),
        F.count_if(~v.isin(0.0, 1.0)).alias("n_not_flag"),
    ]


#: What a profile says of a column. ``total_text`` is what fingerprints take: four decimals, or all digits of the nearest double where values have more than six decimals or 15 digits.
PROFILE = ["n", "n_nan", "total", "total_text", "low", "high", "integral", "n_not_flag"]


def _total_text() -> Column:
    return F.when(F.col("n") == 0, F.lit(None)).when((F.col("n_odd") == 0) & F.col("beyond").isNull(), decimal_text(F.round("decimals", 4))).otherwise(F.col("total").cast("string"))


def profile(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """n, n_nan, exact total, low, high, integral and n_not_flag per column, in one pass.

    Values are grouped by column and by the bin of :mod:`exact_sums` (null for decimals of six places), partial sums first; the
    bins of a column are then merged.
    """
    v = F.when(~F.isnan("value"), F.col("value"))
    high, low = exact_sums.limbs(v, F.col("_bin"))
    return _finished(cells.withColumn("_bin", exact_sums.bin_of(v)).groupBy(*keys, "_bin").agg(*profile_columns(), F.sum(high).alias("_high"), F.sum(low).alias("_low")), keys)


_ADDED = ("n", "n_nan", "decimals", "n_odd", "beyond", "n_not_flag")


def _lowest() -> list[Column]:
    return [F.min("low").alias("low"), F.max("high").alias("high"), F.bool_and("integral").alias("integral")]


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The profile, from partial ones by ``keys`` and bin (a row with null bin for all counts; rows of bins have their limbs only)."""
    limbs = [F.sum(c).alias(c) for c in ("_high", "_low")]
    return _finished(parts.groupBy(*keys, "_bin").agg(*(F.sum(c).alias(c) for c in _ADDED), *_lowest(), *limbs), keys)


def _finished(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    bins = F.collect_list(F.when(F.col("_bin").isNotNull(), F.struct(F.col("_bin").alias("bin"), F.col("_high").alias("high"), F.col("_low").alias("low"))))
    made = parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in _ADDED), *_lowest(), bins.alias("bins"))
    made = made.withColumn("total", F.when(F.col("n") > 0, F.coalesce("beyond", exact_sums.nearest("decimals", "bins"))))
    return made.withColumn("total_text", _total_text()).select(*keys, *PROFILE)


def profile_narrow(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """pos, name and the profile of a few columns: plain aggregates of one row, turned into a row a column; no cell becomes a row.

    A second pass over the columns that hold other values than decimals of six places sums those, and makes rows of those cells only.
    """
    each = lambda c: F.struct(*profile_columns(F.col(c).cast("double")))
    row = df.agg(*(each(c).alias(f"_{i}") for i, c in enumerate(columns)))
    sums = row.select(F.inline(F.array(*(F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name"), F.col(f"_{i}").alias("made")) for i, c in enumerate(columns))))).select("pos", "name", "made.*")
    made = exact_sums.with_total(sums, lambda wanted: exact_sums.odd_cells(df, [F.col(columns[i]).cast("double") for i in wanted]), [*sums.columns, "total"])
    return made.withColumn("total_text", _total_text()).select("pos", "name", *PROFILE)


def short(fingerprint: Column) -> Column:
    """The first 16 characters of a fingerprint, for display."""
    return F.substring(fingerprint, 1, 16)


def column_class() -> Column:
    """What a column holds, from its profile: constants, flags, bytes or floats."""
    return (
        F.when((F.col("low") == 0) & (F.col("high") == 0), "constant_zero")
        .when((F.col("low") == 1) & (F.col("high") == 1), "constant_one")
        .when(F.col("n_not_flag") == 0, "mixed_binary")
        .when(F.col("integral") & (F.col("low") >= 0) & (F.col("high") <= 255), "byte_safe")
        .otherwise("float64")
    )


def classes(profiled: DataFrame) -> DataFrame:
    return profiled.withColumn("class", column_class())


def fingerprint(profiled: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """row_count and content_fingerprint: SHA-256 of the columns' exact sums, to four places where values have six at most, and the row count.

    The profile has one row per column, so the gathered list is as long as the table is wide.
    """
    sums = F.array_sort(F.collect_list(F.struct("pos", F.coalesce("total_text", F.lit("null")).alias("total"))))
    text = F.transform(sums, lambda s: s["total"])
    made = profiled.groupBy(*keys).agg(F.max(F.col("n") + F.col("n_nan")).alias("row_count"), text.alias("sums"))
    body = F.concat(F.lit('{"col_sum":['), F.array_join("sums", ","), F.lit('],"row_count":'), F.col("row_count").cast("string"), F.lit("}"))
    return made.select(*keys, "row_count", F.sha2(body, 256).alias("content_fingerprint"))


def narrowed(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` as bytes where that loses nothing, else null."""
    return df.withColumn(column, byte_or_null(F.col(column)))


def not_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """name, n_not_flag: how many values of each flag column are neither 0 nor 1."""
    return profile_narrow(df, columns).select("name", "n_not_flag")


def out_of_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many values of each column a byte can't hold."""
    return df.agg(*(F.count_if(F.col(c).isNotNull() & byte_or_null(F.col(c)).isNull()).alias(c) for c in columns))
