"""Materialisation history, runs, alerts and the conversion manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wideskein.operators import scans
from wideskein.sources.sinks import read_version, replace_version


def latest_per(df: DataFrame, key: str, time: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key, by one hash aggregate: no sort of a key's history."""
    rest = [c for c in df.columns if c != key]
    top = F.max_by(F.struct(*rest), F.struct(time, *ties)).alias("top")
    return df.groupBy(key).agg(top).select(key, *(F.col(f"top.{c}").alias(c) for c in rest))


def keep_newest(df: DataFrame, time: str, ties: Sequence[str], rows: int = 500) -> DataFrame:
    return df.orderBy(F.desc(time), *ties).limit(rows)


def status_changes(df: DataFrame, keys: Sequence[str], seen: str, status: str = "status", ties: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Rows whose status differs from the one before; a key's first is silent.

    With ``path``, a new folder for the ordered rows, a key may have any number of rows (:mod:`scans`); without, a task holds a key.
    """
    if path:
        before = scans.lag(df, keys, [seen, *ties], status, "previous", path)
    else:
        before = df.withColumn("previous", F.lag(status).over(Window.partitionBy(*keys).orderBy(seen, *ties)))
    return before.where(F.col("previous").isNotNull() & (F.col("previous") != F.col(status)))


def alert_changes(df: DataFrame, keys: Sequence[str], seen: str, status: str = "status", ties: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Of :func:`status_changes` those that alert: a new FAILURE, and a FAILURE that became RESOLVED."""
    changes = status_changes(df, keys, seen, status, ties, path)
    return changes.where((F.col(status) == "FAILURE") | ((F.col("previous") == "FAILURE") & (F.col(status) == "RESOLVED")))


def append_newest(spark: SparkSession, rows: DataFrame, path: str, time: str, ties: Sequence[str], keep: int = 500, versions: int = 10) -> DataFrame:
    """Add ``rows`` to the table at ``path`` and keep its newest ``keep``; the table as it is then, of which the newest ``versions`` stay."""
    held = read_version(spark, path, rows.schema)
    return replace_version(spark, keep_newest(rows if held is None else held.unionByName(rows), time, ties, keep), path, versions)


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n_rows"))


def run_kpis(df: DataFrame, status: str, good: str, bad: str, open_ones: Sequence[str], assets: str, flights: str) -> DataFrame:
    """total, succeeded, failed, in_progress, and how many assets and flights are meant, in one pass."""
    s = F.col(status)
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(s == good).alias("succeeded"), F.count_if(s == bad).alias("failed"), F.count_if(s.isin(list(open_ones))).alias("in_progress"), F.count_distinct(assets).alias("n_assets"), F.count_distinct(flights).alias("n_flights"))


def resolve_alerts(failures: DataFrame, successes: DataFrame, keys: Sequence[str], path: str | None = None) -> DataFrame:
    """Failures with the first later success of their keys: resolved_at, and status RESOLVED where there is one.

    Both are sorted by time, latest first, and the earliest success so far goes along: one pass, however many a key has.
    A success of the same instant doesn't count; a failure without a time is never resolved. With ``path``, a new folder
    for the ordered rows, a key may have any number of rows (:mod:`scans`); without, a task holds a key.
    """
    columns = [c for c in failures.columns if c not in keys and c != "timestamp"]
    bad = failures.select(*keys, "timestamp", F.lit(0).alias("_good"), F.struct(*columns).alias("_row"))
    good = successes.select(*keys, "timestamp", F.lit(1).alias("_good"), F.lit(None).cast(bad.schema["_row"].dataType).alias("_row"))
    order, success = [F.desc_nulls_first("timestamp"), F.asc("_good")], F.when(F.col("_good") == 1, F.col("timestamp"))
    if path:
        both = scans.running_min(bad.unionByName(good), keys, order, success, "resolved_at", path)
    else:
        later = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        both = bad.unionByName(good).withColumn("resolved_at", F.min(success).over(later))
    rows = both.where("_good = 0").select(*keys, "timestamp", *(F.col(f"_row.{c}").alias(c) for c in columns), "resolved_at")
    return rows.withColumn("status", F.when(F.col("resolved_at").isNotNull(), "RESOLVED").otherwise("FAILURE"))


def alert_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.max("timestamp").alias("newest"), F.count(F.lit(1)).alias("n_alerts"), F.count_if(F.col("status") == "FAILURE").alias("n_failed"))


def retry_class(status: Column, attempts: Column, most: Column, updated: Column, now: Column) -> Column:
    """What to do with a manifest row: retry, needs_review, stale (processing for over ten minutes), or nothing."""
    return (
        F.when((status == "processing") & (updated < now - F.expr("INTERVAL 10 MINUTES")), "stale")
        .when((status == "verification_failed") & (attempts < most), "retry")
        .when(status == "verification_failed", "needs_review")
        .otherwise(status)
    )


def record(df: DataFrame, path: str) -> bool:
    """Append history rows; a failed write is reported, not raised, so that it can't fail the run it describes."""
    try:
        df.write.mode("append").parquet(path)
    except Exception as e:
        print(f"history not written: {type(e).__name__}: {str(e)[:200]}")
        return False
    return True


def history_row(df: DataFrame, asset: str, group: str, run_id: str, partition_date: str, flight: str, metadata: Column) -> DataFrame:
    """One row per run: its row count and free-form metadata as JSON."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), metadata.alias("_metadata")).select(
        F.lit(asset).alias("asset_key"), F.lit(group).alias("group_name"), F.lit(run_id).alias("run_id"), F.lit(partition_date).cast("date").alias("partition_date"), F.lit(flight).alias("flight_id"), "row_count", F.to_json("_metadata").alias("metadata")
    )


def running_rows(df: DataFrame, batch: str) -> DataFrame:
    """Rows per batch and so far. Batches are few; their rows are summed before the ordered window."""
    per = df.groupBy(batch).agg(F.count(F.lit(1)).alias("n_rows"))
    return per.withColumn("so_far", F.sum("n_rows").over(Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)))


def metadata_fields(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, field, value) of a JSON object column."""
    return df.select(key, F.explode(F.from_json(column, "map<string,string>")).alias("field", "value"))


def lineage(fingerprinted: DataFrame, pipeline_version: str, revision: str, batches: Sequence[str], path: str) -> DataFrame:
    """One row per published data set: what made it, from which batches, where it lies, and its content fingerprint."""
    return fingerprinted.select(F.lit(pipeline_version).alias("pipeline_version"), F.lit(revision).alias("revision"), F.lit(", ".join(batches)).alias("batches"), F.lit(path).alias("path"), "row_count", "content_fingerprint")
