"""Reconciliation and comparison of copies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wideskein.operators import exact_sums


def counts(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias(name))


def reconcile(layers: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """Keys whose counts differ between layers; a layer without the key differs too (null-safe)."""
    joined = reduce(lambda a, b: a.join(b, "key", "full_outer"), layers)
    same = reduce(lambda a, b: a & b, (F.col(names[0]).eqNullSafe(F.col(n)) for n in names[1:]))
    return joined.where(~same).select("key", *names)


def compare_copies(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], rtol: float = 1e-9, atol: float = 1e-8) -> DataFrame:
    """Per column: rows and exact sum of either copy, the largest difference of a cell, and whether all cells agree within tolerance.

    Cells are compared by key (unique in either copy), so equal sums of swapped values don't pass; a row or a value
    that one side lacks doesn't agree.
    """
    side = lambda df, name: df.select(*keys, F.struct(*(F.col(c).cast("double").alias(c) for c in columns)).alias(name))
    both = side(a, "a").join(side(b, "b"), list(keys), "full_outer")

    def made(c: str):
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        agrees = F.coalesce(F.abs(x - y) <= atol + rtol * F.abs(y), F.col("a").isNotNull() & F.col("b").isNotNull() & x.isNull() & y.isNull())
        return F.struct(F.lit(c).alias("name"), F.count("a").alias("rows_a"), F.count("b").alias("rows_b"), F.max(F.abs(x - y)).alias("max_abs_diff"), F.bool_and(agrees).alias("close"))

    row = both.agg(*(made(c).alias(f"_{i}") for i, c in enumerate(columns)))
    cells = row.select(F.inline(F.array(*(F.col(f"_{i}") for i in range(len(columns))))))
    sums = [exact_sums.totals(df, [F.col(c).cast("double") for c in columns]) for df in (a, b)]
    for side_sums, name in zip(sums, ("sum_a", "sum_b"), strict=True):
        named = F.element_at(F.array(*(F.lit(c) for c in columns)), F.col("pos") + 1)
        cells = cells.join(F.broadcast(side_sums.select(named.alias("name"), F.col("total").alias(name))), "name")  # a row a column
    return cells.select("name", "rows_a", "rows_b", "sum_a", "sum_b", "max_abs_diff", "close")


def compare_cells(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys that one side lacks, or where any cell differs, with the names of the columns that do; zero tolerance."""
    left = a.select(*keys, F.struct(*columns).alias("a"))
    right = b.select(*keys, F.struct(*columns).alias("b"))
    joined = left.join(right, list(keys), "full_outer")
    differ = F.filter(F.array(*(F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in columns)), lambda c: c.isNotNull())
    side = F.when(F.col("a").isNull(), "only_b").when(F.col("b").isNull(), "only_a").when(F.size("differ") > 0, "differs")
    return joined.withColumn("differ", differ).withColumn("finding", side).where("finding is not null").select(*keys, "finding", F.array_join("differ", ",").alias("columns"))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one copy that the other lacks, duplicates counted, with the side they are on."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def schema_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "name string, type string")


def observed_types(df: DataFrame) -> DataFrame:
    """name, type of what the rows hold, column by column: bigint or double if every value reads as one, else string; void without values."""
    text = lambda c: F.col(f"`{c}`").cast("string")
    fits = lambda c, kind: F.count(text(c)) == F.count(text(c).try_cast(kind))
    seen = lambda c: F.when(F.count(text(c)) == 0, "void").when(fits(c, "bigint"), "bigint").when(fits(c, "double"), "double").otherwise("string")
    row = df.agg(*(seen(c).alias(f"_{i}") for i, c in enumerate(df.columns)))
    return row.select(F.inline(F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"_{i}").alias("type")) for i, c in enumerate(df.columns)))))


def schema_difference(expected: DataFrame, found: DataFrame) -> DataFrame:
    """name, finding (missing, extra, type) from two tables of (name, type)."""
    joined = expected.withColumnRenamed("type", "expected").join(found.withColumnRenamed("type", "found"), "name", "full_outer")
    finding = F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra").when(F.col("expected") != F.col("found"), "type")
    return joined.withColumn("finding", finding).where("finding is not null").select("name", "expected", "found", "finding")


def unseen(listed: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return listed.join(seen, key, "left_anti")


def valid_days(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows whose day is in the calendar of partitions."""
    return df.where(F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def share_shift(raw: DataFrame, kept: DataFrame, column: str) -> DataFrame:
    """Per value: its share before and after, and the change."""

    def share(df: DataFrame, name: str) -> DataFrame:
        counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return counted.select(column, (F.col("n") / counted.agg(F.sum("n")).scalar()).alias(name))

    joined = share(raw, "share_raw").join(share(kept, "share_kept"), column, "full_outer").na.fill(0.0, ["share_raw", "share_kept"])
    return joined.withColumn("shift", F.col("share_kept") - F.col("share_raw"))
