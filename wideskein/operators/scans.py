"""Running values over the ordered rows of a key that no task need hold whole.

A window has all rows of a key in one task. Here rows are laid out by ranges of (keys, order), so a key with many
rows lies in several splits; each split's part of a key is summed up in one row, what the splits before hold is folded from those
rows and joined to the key's rows of the next, and windows run inside a split's part only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def laid_out(df: DataFrame, order: Sequence[Column], path: str, splits: int | None = None) -> DataFrame:
    """``df`` written to ``path`` in ``splits`` ranges of ``order``, and read again with ``_split``, which rises along it.

    The ranges come from a sample, so that another run would cut elsewhere: hence the table, which also cuts the lineage. There are as
    many splits as shuffle partitions unless given. Rows that are equal in all of ``order`` lie in one split.
    """
    spark = df.sparkSession
    splits = splits or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(splits, *order).withColumn("_split", F.spark_partition_id())
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def carried(rows: DataFrame, keys: Sequence[str], name: str, part: Column, fold: Callable[[Column], Column]) -> DataFrame:
    """Rows of :func:`laid_out` with ``name``: ``part``, an aggregate, of each earlier split of the row's key, folded in their order.

    ``part`` is one row a key and split. Only the first key of a split can have rows in splits before, so the carried values are at
    most a row a split, and are broadcast.
    """
    parts = rows.groupBy(*keys, "_split").agg(part.alias("_part"))
    before = Window.partitionBy(*keys).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    seen = parts.select("*", F.count(F.lit(1)).over(before).alias("_n"), fold(F.col("_part")).over(before).alias(name)).where("_n > 0")
    as_key = lambda side: [F.struct(*(F.col(k) for k in keys)).alias("_key"), *side]
    small = seen.select(*as_key([F.col("_split").alias("_at"), F.col(name)]))
    keyed = rows.withColumn("_key", F.struct(*(F.col(k) for k in keys)))
    same = (F.col("_split") == F.col("_at")) & keyed["_key"].eqNullSafe(small["_key"])
    return keyed.join(F.broadcast(small), same, "left").select(*rows.columns, name)


def inside(keys: Sequence[str], order: Sequence[Column]) -> WindowSpec:
    """The window of a key's rows in one split, ordered."""
    return Window.partitionBy("_split", *keys).orderBy(*order)


def lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str, path: str, splits: int | None = None) -> DataFrame:
    """``df`` with ``name``: ``column`` of the row before, of the same keys, in ``order``, ascending with nulls first; null for the first.

    ``order`` should name columns that tell a key's rows apart: rows equal in all of them are taken in any order.
    """
    sort = [F.asc(c) for c in order]
    rows = laid_out(df, [*(F.asc(k) for k in keys), *sort], path, splits)
    last = F.max_by(F.struct(column), F.struct(*order))
    rows = carried(rows, keys, "_last", last, lambda p: F.last(p))
    here = inside(keys, sort)
    first = F.row_number().over(here) == 1
    before = F.when(first, F.col(f"_last.{column}")).otherwise(F.lag(column).over(here))
    return rows.select(*df.columns, before.alias(name))


def running_min(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, name: str, path: str, splits: int | None = None) -> DataFrame:
    """``df`` with ``name``: the least ``value`` of the rows before, of the same keys, in ``order``; null where there is none."""
    rows = laid_out(df, [*(F.asc(k) for k in keys), *order], path, splits)
    rows = carried(rows, keys, "_least", F.min(value), F.min)
    here = inside(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(*df.columns, F.least(F.col("_least"), F.min(value).over(here)).alias(name))


def largest_part(spark: SparkSession, path: str, keys: Sequence[str]) -> int:
    """The most rows of one key in one split of a table of :func:`laid_out`."""
    return spark.read.parquet(path).groupBy(*keys, "_split").count().agg(F.max("count")).first()[0] or 0
