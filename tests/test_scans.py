"""Running values of keys that lie in several splits, against windows of whole keys."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wideskein.operators import history, scans


@pytest.fixture(scope="module")
def rows(spark):
    """6,000 rows, a third of them one key's, another third without a key; statuses and times repeat and are null at times."""
    job = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("j"), (F.col("id") % 50).cast("string")))
    status = F.when(F.col("id") % 11 != 0, F.element_at(F.array(*map(F.lit, ["SUCCESS", "FAILURE", "STARTED"])), (F.xxhash64("id") % 3 + 3).cast("int") % 3 + 1))
    seen = F.when(F.col("id") % 101 != 0, F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(3000))))
    return spark.range(6000).select("id", job.alias("job"), status.alias("status"), seen.alias("timestamp"))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("splits", [1, 7, 40])
def test_lag_over_splits_is_lag_over_keys(spark, tmp_path, rows, splits):
    path = str(tmp_path / "rows")
    got = scans.lag(rows, ["job"], ["timestamp", "id"], "status", "previous", path, splits)
    assert found(got) == found(rows.withColumn("previous", F.lag("status").over(Window.partitionBy("job").orderBy("timestamp", "id"))))
    if splits > 1:
        assert scans.largest_part(spark, path, ["job"]) <= 2 * 6000 / splits  # no split holds a key of 2,000 rows


@pytest.mark.parametrize("splits", [1, 7, 40])
def test_running_min_over_splits_is_running_min_over_keys(spark, tmp_path, rows, splits):
    value = F.when(F.col("status") == "SUCCESS", F.xxhash64("id"))
    order = [F.desc_nulls_first("timestamp"), F.asc("id")]
    got = scans.running_min(rows, ["job"], order, value, "least", str(tmp_path / "rows"), splits)
    whole = Window.partitionBy("job").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    assert found(got) == found(rows.withColumn("least", F.min(value).over(whole)))


def test_ties_repeated_rows_and_no_rows(spark, tmp_path, rows):
    same = spark.createDataFrame([("a", 1, "x")] * 5, "job string, at int, status string")
    assert sorted(r.previous or "" for r in scans.lag(same, ["job"], ["at"], "status", "previous", str(tmp_path / "a"), 4).collect()) == ["", "x", "x", "x", "x"]
    assert scans.lag(same.where("at > 1"), ["job"], ["at"], "status", "previous", str(tmp_path / "b"), 4).count() == 0


def test_alerts_are_resolved_and_reported_alike_with_and_without_splits(spark, tmp_path, rows):
    bad, good = rows.where("status = 'FAILURE'").drop("status"), rows.where("status = 'SUCCESS'").select("job", "timestamp")
    assert found(history.resolve_alerts(bad, good, ["job"], str(tmp_path / "a"))) == found(history.resolve_alerts(bad, good, ["job"]))
    assert found(history.alert_changes(rows, ["job"], "timestamp", "status", ["id"], str(tmp_path / "b"))) == found(history.alert_changes(rows, ["job"], "timestamp", "status", ["id"]))
