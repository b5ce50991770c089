"""Tables of versions: commits, readers of older ones, and their removal."""

import os

import pytest

from wideskein.operators import history
from wideskein.sources import sinks


def rows(spark, n):
    return spark.range(n, n + 3).coalesce(1)


def folders(path):
    return sorted(int(n.split("=")[1]) for n in os.listdir(path) if "=" in n)


def test_disk_is_bounded_and_older_readers_go_on(spark, tmp_path):
    path = str(tmp_path / "table")
    older = None
    for n in range(12):
        made = sinks.replace_version(spark, rows(spark, n), path, keep=3)
        if n == 9:
            older = made
    assert folders(path) == [10, 11, 12] == folders(f"{path}/commits")
    assert sorted(r.id for r in older.collect()) == [9, 10, 11]
    assert sorted(r.id for r in sinks.read_version(spark, path, "id long").collect()) == [11, 12, 13]


def test_a_version_without_commit_is_passed_over_and_replaced(spark, tmp_path):
    path = str(tmp_path / "table")
    assert sinks.read_version(spark, path, "id long") is None
    rows(spark, 70).write.parquet(f"{path}/version=1")
    assert sinks.read_version(spark, path, "id long") is None
    sinks.replace_version(spark, rows(spark, 5), path)
    rows(spark, 80).write.parquet(f"{path}/version=2")
    assert sinks.vacuum(path, 1) == []
    assert sorted(r.id for r in sinks.read_version(spark, path, "id long").collect()) == [5, 6, 7]
    known = sinks.read_version(spark, path, "id long")
    sinks.replace_version(spark, known.selectExpr("id + 1 AS id"), path)
    assert sorted(r.id for r in sinks.read_version(spark, path, "id long").collect()) == [6, 7, 8]
    assert sinks.vacuum(path, 1) == [1] and sinks.vacuum(path, 1) == []
    assert sorted(r.id for r in sinks.read_version(spark, path, "id long").collect()) == [6, 7, 8]


def test_the_newest_version_always_stays(spark, tmp_path):
    with pytest.raises(ValueError, match="stays"):
        sinks.vacuum(str(tmp_path), 0)
    assert sinks.vacuum(str(tmp_path / "nothing"), 1) == []


def test_a_log_of_the_newest_rows_keeps_few_versions(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in range(5):
        held = history.append_newest(spark, rows(spark, 3 * n).withColumnRenamed("id", "t"), path, "t", [], keep=4, versions=2)
    assert sorted(r.t for r in held.collect()) == [11, 12, 13, 14] and folders(path) == [4, 5]
