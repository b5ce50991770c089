"""Browse queries: filtered, distinct, sorted rows, choices, counts and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideskein.functions.filters import not_blank


def wanted_columns(df: DataFrame, columns: Sequence[str] | None, always: Sequence[str] = ()) -> list[str]:
    """The requested columns that exist, all columns if none does, and those that an export always needs."""
    kept = [c for c in columns or [] if c in df.columns] or list(df.columns)
    return [*kept, *(c for c in always if c in df.columns and c not in kept)]


def distinct_rows(df: DataFrame, condition: Column, columns: Sequence[str] | None = None, always: Sequence[str] = ()) -> DataFrame:
    """Distinct rows of the wanted columns, in order of time; by the earliest time of each row if time isn't wanted."""
    names = wanted_columns(df, columns, always)
    rows = df.where(condition)
    if "time" in names:
        return rows.select(*names).distinct().orderBy("time")
    return rows.groupBy(*names).agg(F.min("time").alias("_first")).orderBy("_first").drop("_first")


def count_distinct_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Distinct rows over all columns, whatever is shown."""
    return df.where(condition).distinct().agg(F.count(F.lit(1)).alias("n_rows"))


def choices(df: DataFrame, column: str, blank: bool = True) -> DataFrame:
    """Distinct values in order; without blank ones if so asked."""
    rows = df.select(column).where(F.col(column).isNotNull())
    return (rows if blank else rows.where(not_blank(F.col(column)))).distinct().orderBy(column)


def bounds(df: DataFrame, column: str = "time") -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def rows_per(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, avg, min, max, sum of each column in one pass."""
    parts = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("count", F.count), ("avg", F.avg), ("min", F.min), ("max", F.max), ("sum", F.sum))]
    return df.agg(*parts)


def flag_share(df: DataFrame, flag: Column) -> DataFrame:
    return df.agg(F.count_if(flag).alias("n_true"), F.avg(flag.cast("double")).alias("share"))


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under the names that people read; one that isn't there is passed over."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def preview(df: DataFrame, rows: int = 200) -> DataFrame:
    return df.limit(rows)


def newest(df: DataFrame, by: str, ties: Sequence[str], rows: int) -> DataFrame:
    """The newest rows, ties settled by other columns; a top-k that never sorts everything."""
    return df.orderBy(F.desc(by), *ties).limit(rows)


def only_existing(selected: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """Of the selected values those that the data still has."""
    return selected.join(df.select(column).distinct(), column, "left_semi")
