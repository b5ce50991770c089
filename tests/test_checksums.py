"""Checksums against plain reads."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from wideskein.sources import checksums


def sha(data):
    return hashlib.sha256(data).hexdigest()


def tree(data, piece, fan):
    level = [sha(data[i : i + piece]) for i in range(0, max(len(data), 1), piece)]
    while True:
        level = [sha("".join(level[i : i + fan]).encode()) for i in range(0, len(level), fan)]
        if len(level) == 1:
            return level[0]


@pytest.fixture
def files(tmp_path):
    made = {f"f {n}": os.urandom(n) for n in (0, 1, 9, 10, 11, 39, 40, 41, 95, 160, 161, 1000)}
    for name, data in made.items():
        (tmp_path / name).write_bytes(data)
    return tmp_path, made


@pytest.mark.parametrize(("piece", "fan"), [(10, 4), (10, 2), (1000, 2), (7, 1000)])
def test_trees_of_all_sizes(spark, files, piece, fan):
    path, made = files
    made = {name: data for name, data in made.items() if data}  # empty files aren't listed
    got = {r.file.rsplit("f", 1)[1].replace("%20", " ").strip(): (r.bytes, r.digest) for r in checksums.file_trees(spark, str(path), piece, fan).collect()}
    assert got == {name[2:]: (len(data), tree(data, piece, fan)) for name, data in made.items()}


def test_whole_files(spark, files):
    path, made = files
    made = {name: data for name, data in made.items() if data}  # empty files aren't listed
    got = sorted((r.bytes, r.sha256) for r in checksums.file_checksums(spark, str(path)).collect())
    assert got == sorted((len(d), sha(d)) for d in made.values())


def test_a_file_of_over_two_gigabytes(spark, tmp_path, tmp_path_factory):
    """A sparse file with bytes at its ends: the digest of a plain read, and pieces that tell the one changed byte."""
    list_at = tmp_path_factory.mktemp("list")
    name, size = tmp_path / "big", (2 << 30) + 12345
    with open(name, "wb") as f:
        f.write(b"first")
        f.truncate(size)
        f.seek(size - 4)
        f.write(b"last")
    plain = hashlib.sha256()
    with open(name, "rb") as f:
        while data := f.read(8 << 20):
            plain.update(data)
    assert [(r.bytes, r.sha256) for r in checksums.file_checksums(spark, str(tmp_path)).collect()] == [(size, plain.hexdigest())]
    checksums.file_pieces(spark, str(tmp_path)).write.parquet(str(list_at / "pieces"))
    kept = spark.read.parquet(str(list_at / "pieces"))
    assert kept.count() == 33 and kept.where("number = 32").first().digest == sha(b"\0" * 12341 + b"last")
    with open(name, "r+b") as f:
        f.seek(20 * (64 << 20) + 77)
        f.write(b"x")
    assert [r.number for r in checksums.damaged(kept, checksums.file_pieces(spark, str(tmp_path))).collect()] == [20]


def test_many_files_are_digested_by_many_tasks(spark, tmp_path):
    """Before, Spark put the short rows that name the files into one task, which read all files."""
    spark.range(800).repartition(8).write.parquet(f"{tmp_path}/some")
    some = F.spark_partition_id().alias("task")
    assert checksums.file_checksums(spark, f"{tmp_path}/some").select("file", some).distinct().count() == 8
    assert checksums.file_checksums(spark, f"{tmp_path}/some").select(some).distinct().count() > 1
    assert checksums.file_pieces(spark, f"{tmp_path}/some", 256).select(some).distinct().count() > 8


def test_written_files_grow_in_number_not_in_size(spark, tmp_path):
    """Before, three tasks wrote a table of any size."""
    from wideskein.plans import queries as plans

    spark.range(60_000).selectExpr("id as l_orderkey", "cast(id % 50 as double) as l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    held, made = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"), plans.scratch
    try:
        plans.scratch = lambda spark, name: str(tmp_path / name)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
        row = plans.queries()["write_metrics"](spark, str(tmp_path)).first()
    finally:
        plans.scratch = made
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", held)
    assert (row.n_rows, row.rows_in_files, row.total, row.measured) == (60_000, 60_000, 1_470_000.0, True)
    assert len(list((tmp_path / "metrics").glob("part-*"))) > 3
