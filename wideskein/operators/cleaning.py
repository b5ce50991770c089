"""Coercion, deduplication and the file-to-rows step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideskein.functions.filters import on_day
from wideskein.functions.scalars import nan_to_null

REQUIRED = ("time", "latitude", "longitude")
NUMBERS = ("latitude", "longitude", "altitude", "velocity_x", "velocity_y", "velocity_z", "roll", "pitch", "yaw", "box_x", "box_y", "box_w", "box_h")


def require(df: DataFrame, columns: Sequence[str]) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns {missing}; found {df.columns}")


def cast_all(df: DataFrame, kind: str = "double") -> DataFrame:
    return df.select(*(F.col(f"`{c}`").cast(kind).alias(c) for c in df.columns))


def coerce(df: DataFrame, numbers: Sequence[str] = NUMBERS, times: Sequence[str] = ("time",)) -> DataFrame:
    """Texts to numbers and times, what does not parse to null; a missing column is an error."""
    require(df, [*numbers, *times])
    made = {c: F.col(c).try_cast("double") for c in numbers} | {c: F.try_to_timestamp(F.col(c).cast("string")) for c in times}
    return df.withColumns(made)


def with_flight(df: DataFrame, configured: str | None = None, stem: str = "_stem") -> DataFrame:
    """flight_id from the configuration (trimmed), else from the file name; it replaces a column of that name."""
    named = F.lit(configured.strip()) if configured and configured.strip() else F.col(stem)
    return df.withColumn("flight_id", named).drop(stem)


def drop_incomplete(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    return df.dropna(subset=list(required))


def drop_repeats(df: DataFrame) -> DataFrame:
    """Whole-row duplicates once."""
    return df.dropDuplicates()


def nans_to_nulls(df: DataFrame) -> DataFrame:
    floats = {f.name: nan_to_null(F.col(f.name)) for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.withColumns(floats) if floats else df


def nan_counts(df: DataFrame) -> DataFrame:
    """How many NaN each float column holds, before they become null."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.agg(*(F.count_if(F.isnan(c)).alias(c) for c in floats))


def raw_day(df: DataFrame, day: str, flight: str | None = None) -> DataFrame:
    """One file's rows of one day, time parsed and flight named."""
    require(df, ["time"])
    timed = with_flight(df, flight).withColumn("time", F.try_to_timestamp(F.col("time").cast("string")))
    return timed.where(on_day(F.col("time"), day))


def processed(df: DataFrame, numbers: Sequence[str] = NUMBERS, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Coerced, complete, without repeats and without NaN."""
    return drop_repeats(drop_incomplete(nans_to_nulls(coerce(df, numbers)), required))
