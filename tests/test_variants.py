"""Metadata whose types are kept."""

import pytest
from pyspark.sql import functions as F

from wideskein.functions import variants

ENTRIES = "array<struct<label string, text string, int_value bigint, float_value double, bool_value boolean, json string>>"


def fields(spark, df):
    return {r.field: tuple(r)[2:] for r in variants.typed_fields(df.withColumn("id", F.lit(1)), "id", "v").collect()}


def test_entries_keep_their_types_through_parquet(spark, tmp_path):
    rows = [("n", None, 7, None, None, None), ("x", None, None, 0.1, None, None), ("ok", None, None, None, False, None), ("t", "12", None, None, None, None), ("j", None, None, None, None, '{"a":[1,true]}'),
            ("raw", None, None, None, None, "x{"), ("none", None, None, None, None, None), (None, "lost", None, None, None, None), ("n", None, 8, None, None, None)]
    df = spark.createDataFrame([(rows,)], f"e {ENTRIES}").select(variants.overlay(variants.entries_to_variants(F.col("e")), F.lit(None).cast("map<string,variant>")).alias("v"))
    df.write.parquet(str(tmp_path / "v"))
    none = (None,) * 5
    assert fields(spark, spark.read.parquet(str(tmp_path / "v"))) == {
        "n": ("int", 8, *none[1:]), "x": ("float", None, 0.1, *none[2:]), "ok": ("bool", None, None, False, None, None), "t": ("text", None, None, None, "12", None),
        "j": ("json", None, None, None, None, '{"a":[1,true]}'), "raw": ("text", None, None, None, "x{", None), "none": ("null", *none),
    }


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"a": 1, "b": 1.5, "c": "1", "d": null, "e": [1, {"f": 2}], "g": true}', {"a": "int", "b": "float", "c": "text", "d": "null", "e": "json", "g": "bool"}),
        ('{"a": 12345678901234567890123, "b": 1e400, "c": 1e3}', {"a": "float", "b": "float", "c": "float"}),
        ("[1, 2]", {}),
        ("no json", {}),
        ("{}", {}),
        (None, {}),
    ],
)
def test_kinds_of_json(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(variants.json_or_string(F.col("t")).alias("v"))
    got = {k: v[0] for k, v in fields(spark, df).items()}
    assert got == expected


def test_base_wins_and_no_entries(spark):
    df = spark.createDataFrame([([("k", "base", None, None, None, None)], [("k", None, 1, None, None, None), ("m", None, 2, None, None, None)])], f"a {ENTRIES}, b {ENTRIES}")
    made = df.select(variants.overlay(variants.entries_to_variants(F.col("a")), variants.entries_to_variants(F.col("b"))).alias("v"))
    assert made.select(F.to_json("v")).first()[0] == '{"k":"base","m":2}'
    nothing = spark.createDataFrame([([], None)], f"a {ENTRIES}, b {ENTRIES}")
    assert nothing.select(F.to_json(variants.overlay(variants.entries_to_variants(F.col("a")), variants.entries_to_variants(F.col("b"))))).first()[0] == "{}"
