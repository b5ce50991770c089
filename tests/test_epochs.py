"""Epochs whose unit is known, over and under the size that milliseconds are told by."""

import pytest
from pyspark.sql import functions as F

from wideskein.functions import scalars
from wideskein.plans import queries as plans


def test_epoch_convert_of_seconds_over_1e10(spark, tmp_path):
    spark.createDataFrame([(0,), (96_064,), (96_065,), (99_999,)], "event_id long").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = {r.event_id: (r.s, r.ms) for r in plans.queries()["epoch_convert"](spark, str(tmp_path)).selectExpr("event_id", "unix_micros(as_seconds) as s", "unix_micros(as_millis) as ms").collect()}
    assert found == {n: ((n * 86_400 + 1_700_000_000) * 1_000_000, (n + 1_700_000_000_000) * 1_000) for n in (0, 96_064, 96_065, 99_999)}


def test_a_known_unit_holds_for_all_values(spark):
    row = spark.range(1).select(*(scalars.epoch_to_time(F.lit(v).cast("double"), unit).cast("string").alias(n) for n, v, unit in (("guessed", 2e10, None), ("s", 2e10, "s"), ("ms", 5000, "ms")))).first()
    assert (row.guessed, row.s, row.ms) == ("1970-08-20 11:33:20", "2603-10-11 11:33:20", "1970-01-01 00:00:05")
    with pytest.raises(ValueError):
        scalars.epoch_to_time(F.lit(1.0), "us")
