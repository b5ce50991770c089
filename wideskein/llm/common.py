"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where that is unset, local mode (tests) gets a folder of its own; a cluster must set it."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("wideskein.shared.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("wideskein.shared.dir", path)
    return path.rstrip("/")


#: Tables written within each open :func:`passing` block of this thread, as ``blocks``.
_passing = threading.local()


def _tables_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/wideskein/{spark.sparkContext.applicationId}"


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove_tables(spark: SparkSession) -> None:
    """Remove all tables that :func:`cut` wrote for this application. Its owner calls it once no result that reads them is needed."""
    _remove(spark, _tables_dir(spark))


def cut(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here and a lost executor loses nothing.

    Within :func:`passing` the table is removed at the end of the block, unless it is to ``keep``.
    """
    spark = df.sparkSession
    path = f"{_tables_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    blocks = getattr(_passing, "blocks", None)
    if blocks and not keep:
        blocks[-1].append(table)
    return table


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables that this thread writes by :func:`cut` inside, and those added to the list, are removed at the end, also after an error: their readers have run by then."""
    blocks = _passing.__dict__.setdefault("blocks", [])
    tables: list[DataFrame] = []
    blocks.append(tables)
    try:
        yield tables
    finally:
        blocks.pop()
        for folder in {f.rsplit("/", 1)[0] for table in tables for f in table.inputFiles()}:
            _remove(spark, folder)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_hash(column: str = "text") -> Column:
    return F.xxhash64(text_or_empty(column))


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def bucket_count(rows: Column | int, rows_per_bucket: int = 2000) -> Column:
    """How many hash buckets a group of that many rows is dealt into."""
    rows = rows if isinstance(rows, Column) else F.lit(rows)
    return F.greatest(F.lit(1), F.ceil(rows / rows_per_bucket)).cast("long")


def _dealt(df: DataFrame, order: list[str], buckets: Column) -> DataFrame:
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*order), buckets))


def gapless_position(df: DataFrame, group: str, order: list[str], out: str, buckets: Column) -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps, without gathering a group in one task.

    A group is dealt into hash buckets (``buckets``, by its own size); a row's number is the count of the group's
    earlier buckets plus its rank in its own bucket, so a group of any size is ranked in small pieces.
    ``group`` holds no nulls. Rows that agree in all of ``order`` are ranked in any order.
    """
    dealt = _dealt(df, order, buckets)
    counts = dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(inside) - 1)
    return ranked.join(base, [group, "_bucket"]).withColumn(out, (F.col("_base") + F.col("_rank")).cast("long")).drop("_bucket", "_rank", "_base")


def running_total(df: DataFrame, group: list[str], order: list[str], value: str, out: str, buckets: Column) -> DataFrame:
    """Sum of ``value`` over the rows of the group before each row, in a fixed order that starts with a hash bucket.

    Buckets as in :func:`gapless_position`; ``group`` columns hold no nulls.
    """
    dealt = _dealt(df, order, buckets)
    sums = dealt.groupBy(*group, "_bucket").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*group, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("_before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(base, [*group, "_bucket"]).withColumn(out, (F.col("_base") + F.col("_before")).cast("long")).drop("_bucket", "_before", "_base")


def in_order(df: DataFrame, order: list[Column], out: str, name: str) -> DataFrame:
    """Number the rows from 0 without gaps in the order given, however many agree in it; the numbered rows are a table.

    Rows are dealt by range, with a row's place in the input as the last key, so equal rows fill as many ranges as they
    need. What is summed over all is a count for each range.
    """
    place = F.monotonically_increasing_id()  # range in the upper bits, row within it in the lower 33
    dealt = df.withColumn("_tie", place).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    table = cut(dealt.withColumn("_at", place), name)
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = table.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    at = (F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")
    return table.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(out, at).drop("_at", "_part", "_start")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of this session hold few rows: a Python worker and the JVM beside it hold a batch or two whole, and texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(batches: Iterable, rows: int = 256) -> Iterator:
    """Arrow batches in pieces of at most ``rows`` rows, so that a task holds few texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def keep_first(docs: DataFrame, grouped: DataFrame, most_broadcast: int, name: str) -> DataFrame:
    """The rows of ``docs`` with one row of each group, all columns as they were.

    ``grouped`` has doc_id, text_hash and group for every row. The row with the smallest (doc_id, text hash) stays,
    null doc_ids last; of rows that agree in both any one. A row is found again by doc_id and text, so rows that
    share a doc_id, or have none, are decided one by one. Names beginning with ``_near_`` are reserved.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    sizes = grouped.groupBy("group").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rows = grouped.groupBy("group", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_near_rows")).join(sizes, "group")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    rows = rows.withColumn("_near_kept", kept).where("not _near_kept or _near_rows > 1")
    decided = cut(rows.select(F.col("doc_id").alias("_near_id"), F.col("text_hash").alias("_near_text"), "_near_kept"), name)
    return keep_decided(docs, decided, most_broadcast)


def keep_decided(docs: DataFrame, decided: DataFrame, most_broadcast: int) -> DataFrame:
    """The rows of ``docs`` without those that ``decided`` (_near_id, _near_text, _near_kept) names, and with one of the rows of each that it keeps.

    Beyond ``most_broadcast`` decisions rows are shuffled once, by text hash and doc_id, of which rows that no decision
    names have as many as there are texts.
    """
    if decided.count() <= most_broadcast:
        decided = F.broadcast(decided)
    mine = docs.withColumn("_near_hash", text_hash())
    named = mine.join(decided, F.col("_near_hash").eqNullSafe(F.col("_near_text")) & F.col("doc_id").eqNullSafe(F.col("_near_id")), "left")
    single = named.where("_near_kept is null")
    repeated = named.where("_near_kept").dropDuplicates(["_near_id", "_near_text"])
    return single.unionByName(repeated).select(*(F.col(f"`{c}`") for c in docs.columns))
