"""The driver's tables seen as the tables this library is about."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as curated telemetry: time, flight, class, altitude."""
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("time"), F.col("user_id").cast("string").alias("flight_id"), F.col("event_type").alias("class"), F.col("value").alias("altitude"))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry as texts with planted bad times, bad numbers, NaN and repeats, by rules on event_id."""
    e = telemetry(spark, sf_dir)
    n = F.col("event_id")
    rows = e.select(
        F.when(n % 11 == 0, "not a time").otherwise(F.date_format("time", "yyyy-MM-dd HH:mm:ss")).alias("time"),
        F.when(n % 7 == 0, "x").when(n % 13 == 0, "NaN").otherwise(F.col("altitude").cast("string")).alias("altitude"),
        "class",
        "flight_id",
        "event_id",
    )
    return rows.unionByName(rows.where(n % 5 == 0))
