"""Files as they arrive: each file once, rows routed to their own days, late rows kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wideskein.sources.sinks import load_days, read_days, read_version, replace_version


def arriving(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", per_trigger: int = 100) -> DataFrame:
    """New files of a folder as a stream; the checkpoint remembers which were seen."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).option("recursiveFileLookup", "true")
    return reader.format(kind).load(path).withColumn("source_file", F.col("_metadata.file_path"))


def in_calendar(first: str, last: str | None = None):
    """Whether a row's day is one that is loaded; a null time never is."""
    day = F.to_date("time")
    upper = F.lit(last).cast("date") if last else F.current_date()
    return F.coalesce(day.between(F.lit(first).cast("date"), upper), F.lit(False))


def load_arrivals(stream: DataFrame, table: str, quarantine: str, checkpoint: str, first: str, last: str | None = None, every: str | None = None):
    """Start a query that appends arriving rows by day, flight and batch, and out-of-range rows to quarantine.

    All files there are, or every so often (``every``, as ``10 seconds``). A batch writes what it holds and nothing
    else, so its cost doesn't grow with the table; a replayed batch replaces its own files. :func:`settled` reads the
    table with one row a key, :func:`compact` rewrites it so.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows = rows.persist()
        valid = in_calendar(first, last)
        marked = rows.withColumn("batch", F.lit(number))
        refused = marked.where(~valid).withColumn("event_date", F.to_date("time"))
        refused.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch").parquet(quarantine)
        load_days(marked.where(valid).drop("source_file"), table, ["batch"])
        rows.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def refused(spark: SparkSession, quarantine: str, schema: StructType, first: str, last: str | None = None) -> DataFrame:
    """The rows in quarantine that a calendar still does not load, with the batch that brought them and their source file."""
    return _quarantined(spark, quarantine, schema).where(~in_calendar(first, last)).drop("event_date")


def _quarantined(spark: SparkSession, quarantine: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields, *StructType.fromDDL("source_file string, event_date date, batch int").fields])).parquet(quarantine)


def redrive(spark: SparkSession, quarantine: str, table: str, schema: StructType, before: tuple[str, str | None], now: tuple[str, str | None]) -> int:
    """Load what was refused under the calendar ``before`` and is valid ``now``, as part of the batches that brought it; how many rows.

    Quarantine keeps its rows: it says what was ever refused, :func:`refused` what still is. Only the folders of the days
    that the calendar gained are read. Their partitions in the table, a day, flight and batch each, hold nothing else, so doing it
    again, or after a failure halfway, replaces what was written. A later batch's row of the same key stays the newer one.
    """
    day = F.col("event_date")
    span = lambda first, last: day.between(F.lit(first).cast("date"), F.lit(last).cast("date") if last else F.current_date())
    rows = _quarantined(spark, quarantine, schema).where(day.isNotNull() & span(*now) & ~span(*before))
    load_days(rows.drop("source_file", "event_date"), table, ["batch"])
    return rows.count()


def settled(spark: SparkSession, table: str, schema: StructType, keys: Sequence[str], batch: bool = False) -> DataFrame:
    """The rows of a table of :func:`load_arrivals`, of each key the one from the newest batch (named, if ``batch``); of one batch's any one, always the same."""
    full = StructType([*schema.fields, *StructType.fromDDL("event_date date, batch int").fields])
    rows = read_days(spark, table, full)
    rest = [c for c in rows.columns if c not in keys]
    top = F.max(F.struct("batch", *(c for c in rest if c != "batch"))).alias("top")
    return rows.groupBy(*keys).agg(top).select(*(F.col(c) if c in keys else F.col(f"top.{c}").alias(c) for c in [*schema.fieldNames(), "event_date", *(["batch"] if batch else [])]))


def compact(spark: SparkSession, table: str, schema: StructType, keys: Sequence[str], into: str) -> None:
    """The settled rows as a table of days and flights of its own."""
    load_days(settled(spark, table, schema, keys).drop("event_date"), into)


def without_repeats(stream: DataFrame, keys: list[str], delay: str = "1 day") -> DataFrame:
    """A stream's re-delivered rows once, with state bounded by a watermark."""
    return stream.withWatermark("time", delay).dropDuplicatesWithinWatermark(keys)


def new_alerts(spark: SparkSession, batch: DataFrame, state_path: str, keys: list[str], keep: int = 10) -> DataFrame:
    """Alerts of a batch that are new: a FAILURE where the last status seen of the key is another or none, and a FAILURE that is RESOLVED.

    The last status of every key is a table; this batch's becomes its next version, once the changes are written
    beside it, so a batch that fails halfway is done anew against the old one. The newest ``keep`` versions stay.
    """
    latest = batch.groupBy(*keys).agg(F.max_by(F.struct(*(c for c in batch.columns if c not in keys)), "timestamp").alias("row")).select(*keys, "row.*")
    schema = StructType([*(batch.schema[k] for k in keys), *StructType.fromDDL("status string").fields])
    known = read_version(spark, f"{state_path}/last", schema)
    if known is None:
        known = spark.createDataFrame([], schema)
    met = latest.join(known.withColumnRenamed("status", "known"), keys, "left")
    changed = met.where("status = 'FAILURE' and not (known <=> 'FAILURE') or status = 'RESOLVED' and known = 'FAILURE'")
    changed = replace_version(spark, changed, f"{state_path}/changes", keep)
    now = known.join(latest.select(*keys), keys, "left_anti").unionByName(latest.select(*keys, "status"))
    replace_version(spark, now, f"{state_path}/last", keep)
    return changed
