"""Declarative data checks: every rule is evaluated, in one aggregate, before anything fails."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``failures`` counts the rows that break the rule; it is an aggregate column."""

    name: str
    failures: Column


def exact_columns(df: DataFrame, expected: Sequence[str]) -> Rule:
    return Rule("columns", F.lit(len(set(df.columns) ^ set(expected))).cast("long"))


def in_range(column: str, low: float, high: float) -> Rule:
    """Null passes, here and in :func:`allowed`; :func:`not_null` says if it may."""
    return Rule(f"{column}_range", F.count_if(~F.col(column).between(low, high)))


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", F.count_if(F.col(column).isNull()))


def of_type(df: DataFrame, column: str, kind: str) -> Rule:
    return Rule(f"{column}_type", F.lit(int(df.schema[column].dataType.simpleString() != kind)).cast("long"))


def mean_in_range(column: str, low: float, high: float) -> Rule:
    return Rule(f"{column}_mean", F.when(F.avg(column).between(low, high), F.lit(0)).otherwise(F.lit(1)).cast("long"))


def allowed(column: str, values: Sequence) -> Rule:
    return Rule(f"{column}_allowed", F.count_if(~F.col(column).isin(list(values))))


def holds(name: str, condition: Column) -> Rule:
    return Rule(name, F.count_if(~F.coalesce(condition, F.lit(False))))


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule, failures: one pass over ``df``."""
    row = df.agg(*(F.coalesce(r.failures, F.lit(0)).cast("long").alias(r.name) for r in rules))
    return row.select(F.inline(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("failures")) for r in rules))))


def summary(results: DataFrame) -> DataFrame:
    """evaluated, successful, unsuccessful, percent, success."""
    good = F.count_if(F.col("failures") == 0)
    n = F.count(F.lit(1))
    return results.agg(n.alias("evaluated"), good.alias("successful"), (n - good).alias("unsuccessful"), F.round(100.0 * good / n, 2).alias("percent"), (n == good).alias("success"))


def enforce(results: DataFrame) -> None:
    """Raise with all broken rules; a few rows reach the driver."""
    if broken := [(r.rule, r.failures) for r in results.where("failures > 0").collect()]:
        raise ValueError(f"broken rules: {broken}")


def repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def boxes(width: str, height: str, x: str, y: str, image_width: float, image_height: float) -> list[Rule]:
    """Boxes have a size and lie inside the image."""
    inside = (F.col(x) >= 0) & (F.col(y) >= 0) & (F.col(x) + F.col(width) <= image_width) & (F.col(y) + F.col(height) <= image_height)
    return [holds("box_size", (F.col(width) > 0) & (F.col(height) > 0)), holds("box_inside", inside)]


def sequence_split(df: DataFrame, sequence: str, shares: Sequence[tuple[str, int]]) -> DataFrame:
    """Whole sequences go to one part: a hash of the key, of any type, says which, so that runs and strides of keys don't matter.

    A null key is a sequence of its own.
    """
    total = sum(n for _, n in shares)
    text = F.coalesce(F.col(sequence).cast("string"), F.lit(""))
    bucket = F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(total))
    split, edge = None, 0
    for name, n in shares:
        edge += n
        split = F.when(bucket < edge, name) if split is None else split.when(bucket < edge, name)
    return df.withColumn("split", split)


def split_sizes(split: DataFrame, sequence: str, names: Sequence[str]) -> DataFrame:
    """split, n_sequences, n_rows of every part, those that got nothing too."""
    counted = split.groupBy("split").agg(F.count_distinct(F.coalesce(F.col(sequence).cast("string"), F.lit(""))).alias("n_sequences"), F.count(F.lit(1)).alias("n_rows"))
    all_parts = split.sparkSession.createDataFrame([(n,) for n in names], "split string")
    return all_parts.join(counted, "split", "left").na.fill(0)


def fixed_buckets(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Rows per [edge, next edge)."""
    bucket = sum((F.col(column) >= e).cast("int") for e in edges)
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))
