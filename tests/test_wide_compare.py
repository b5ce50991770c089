"""Copies of wide rows by block digests."""

import pytest
from pyspark.sql import functions as F

from wideskein.operators import wide_compare
from wideskein.sources import readers, sinks

ROWS = "file string, line long, values array<double>"
NAN = float("nan")


def found(a, b, lines=10):
    return sorted(tuple(r) for r in wide_compare.compare_wide(a, b, lines).collect())


def test_one_changed_cell_of_many_is_found_in_its_block(spark):
    a = spark.range(2000).select((F.col("id") % 2).cast("string").alias("file"), F.col("id").alias("line"), F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: i * 0.5 + F.col("id")).alias("values"))
    b = a.withColumn("values", F.when(F.col("line") == 777, F.transform("values", lambda v, i: F.when(i == 41, v + 1e-9).otherwise(v))).otherwise(F.col("values")))
    assert [tuple(r) for r in wide_compare.differing_blocks(a, b, 100).collect()] == [("1", 7)]
    got = found(a, b, 100)
    assert [r[:4] for r in got] == [("1", 777, "differs", 41)] and got[0][4] == 797.5 and got[0][5] > 797.5
    assert found(a, a) == []


@pytest.mark.parametrize(
    ("x", "y", "expected"),
    [
        ([1.0, None], [None, 1.0], [("differs", 0, 1.0, None), ("differs", 1, None, 1.0)]),
        ([None], [], [("only_a", 0, None, None)]),
        ([], [None, 2.0], [("only_b", 0, None, None), ("only_b", 1, None, 2.0)]),
        ([0.0, NAN], [-0.0, NAN], []),
        (None, [], []),
        ([1.0, 2.0], [2.0, 1.0], [("differs", 0, 1.0, 2.0), ("differs", 1, 2.0, 1.0)]),
        ([1e308], [float("inf")], [("differs", 0, 1e308, float("inf"))]),
    ],
)
def test_nulls_widths_and_special_values(spark, x, y, expected):
    a, b = spark.createDataFrame([("f", 1, x)], ROWS), spark.createDataFrame([("f", 1, y)], ROWS)
    assert [r[2:] for r in found(a, b)] == expected


def test_lines_that_changed_places_or_lack_on_a_side_and_empty_copies(spark):
    a = spark.createDataFrame([("f", 1, [1.0]), ("f", 2, [2.0]), ("g", 1, [3.0])], ROWS)
    b = spark.createDataFrame([("f", 1, [2.0]), ("f", 2, [1.0]), ("h", 1, [3.0])], ROWS)
    assert found(a, b) == [("f", 1, "differs", 0, 1.0, 2.0), ("f", 2, "differs", 0, 2.0, 1.0), ("g", 1, "only_a", None, None, None), ("h", 1, "only_b", None, None, None)]
    nothing = spark.createDataFrame([], ROWS)
    assert found(nothing, nothing) == [] and len(found(a, nothing)) == 3


def test_blocks_beyond_the_broadcast_limit_give_the_same(spark, monkeypatch):
    a = spark.range(100).select(F.lit("f").alias("file"), F.col("id").alias("line"), F.array(F.col("id").cast("double")).alias("values"))
    b = a.withColumn("values", F.when(F.col("line") % 7 == 0, F.array(F.lit(-1.0))).otherwise(F.col("values")))
    once = found(a, b)
    monkeypatch.setattr(wide_compare, "BROADCAST_BLOCKS", 0)
    assert found(a, b) == once and len(once) == 15


def test_tab_files_against_their_parquet_copy(spark, tmp_path):
    """Lines are numbered across the splits of a file; the copy lost one last bit of a value."""
    (tmp_path / "tab").mkdir()
    for name, n in (("one", 400), ("two", 30)):
        (tmp_path / "tab" / f"{name}.tab").write_text("t\tx\t\n" + "".join(f"{i}\t{i / 7!r}\t\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        tab = readers.numbered_rows(spark, str(tmp_path / "tab"))
        sinks.write_columnar(tab, str(tmp_path / "copy"))
        copy = spark.read.parquet(str(tmp_path / "copy"))
        assert tab.rdd.getNumPartitions() > 1 and found(tab, copy) == []
        bent = copy.withColumn("values", F.when((F.col("file") == "one") & (F.col("line") == 302), F.array(F.get("values", F.lit(0)), F.lit(42.99999999999999))).otherwise(F.col("values")))
        assert [r[:4] for r in found(tab, bent, 50)] == [("one", 302, "differs", 1)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
