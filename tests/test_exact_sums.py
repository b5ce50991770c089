"""Sums of doubles against rational numbers."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wideskein.operators import exact_sums, profiling, reconciling, wide_profile


def nearest(values):
    """Decimals of six places count by their digits, anything else as the double it is."""
    exact = Fraction(0)
    for v in values:
        digits = Fraction(repr(v))
        exact += digits if abs(v) < 1e15 and (digits * 10**6).denominator == 1 else Fraction(v)
    return exact.numerator / exact.denominator


def columns(seed):
    r = random.Random(seed)
    made = {
        "tiny": [1e-7] * 1000,
        "large": [1e23] * 1000,
        "cancel": [x for _ in range(300) for v in [r.uniform(1, 9) * 10.0 ** r.randint(-300, 300)] for x in (v, -v)] + [3e-200, 1e-310, 5e-324],
        "spread": [r.choice([-1, 1]) * r.random() * 2.0 ** r.randint(-1060, 1000) for _ in range(900)],
        "edges": [2.0**k for k in range(-1074, 1010)] + [math.nextafter(2.0**k, 0) for k in range(-1000, 1010, 3)],
        "decimals": [r.randint(-(10**9), 10**9) / 100 for _ in range(900)],
        "mixed": [0.1, 0.2, 0.3] * 100 + [1 / 3] * 100 + [1e15, 123456789.123456, 999999999999999.9],
        "none": [None] * 5,
    }
    return made


@pytest.mark.parametrize("parts", [1, 7])
def test_profiles_hold_the_nearest_double(spark, parts):
    made = columns(4)
    rows = [(name, v) for name, vs in made.items() for v in vs]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "name string, value double").repartition(parts)
    want = {name: nearest([v for v in vs if v is not None]) if name != "none" else None for name, vs in made.items()}
    assert {r.name: r.total for r in profiling.profile(df, ["name"]).collect()} == want
    narrow = df.select(*(F.when(F.col("name") == name, F.col("value")).alias(name) for name in made))
    got = profiling.profile_narrow(narrow, list(made))
    assert {r.name: r.total for r in got.collect()} == want
    assert [r.name for r in got.orderBy("pos").collect()] == list(made)


def test_infinities_and_nan(spark):
    df = spark.createDataFrame([("a", math.inf), ("a", 1.5), ("b", math.inf), ("b", -math.inf), ("c", math.nan), ("c", 1e-9), ("d", 1e308), ("d", 1e308)], "name string, value double")
    got = {r.name: (r.n, r.n_nan, r.total) for r in profiling.profile(df, ["name"]).collect()}
    assert got["a"] == (2, 0, math.inf) and math.isnan(got["b"][2]) and got["c"] == (1, 1, 1e-9) and got["d"][2] == math.inf


def test_fingerprints_of_small_and_large_values_differ(spark):
    def print_of(values):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
        narrow = profiling.fingerprint(profiling.profile_narrow(df, ["x"])).first().content_fingerprint
        long = profiling.fingerprint(profiling.profile(df.select(F.lit(0).alias("pos"), F.col("x").alias("value")), ["pos"])).first().content_fingerprint
        assert narrow == long
        return narrow

    values = [[1e-7, 2e-7], [1e-7, 3e-7], [1e23, 2e23], [1e23, 3e23], [0.5, 0.25], [0.25, 0.25]]
    assert len({print_of(v) for v in values}) == len(values)
    assert print_of([1e-7, 5.0, 1e23]) == print_of([1e23, 1e-7, 5.0])


def test_copies_of_any_magnitude(spark):
    a = spark.createDataFrame([(i, 1e-7 * (i + 1), 1e23 * i, float(i)) for i in range(50)], "k long, x double, y double, z double")
    b = a.withColumn("z", F.when(F.col("k") == 7, 9.0).otherwise(F.col("z")))
    got = {r.name: r for r in reconciling.compare_copies(a, b, ["k"], ["x", "y", "z"]).collect()}
    assert got["x"].sum_a == got["x"].sum_b == nearest([1e-7 * (i + 1) for i in range(50)])
    assert got["y"].sum_a == got["y"].sum_b == nearest([1e23 * i for i in range(50)])
    assert (got["z"].sum_a, got["z"].sum_b, got["z"].close) == (1225.0, 1227.0, False) and got["x"].close
    assert exact_sums.totals(a.limit(0), [F.col("x")]).first().total is None


def wide_rows(seed):
    r, rows = random.Random(seed), []
    kinds = [lambda: r.uniform(-500, 500), lambda: round(r.uniform(-500, 500), 6), lambda: float(r.randint(0, 1)), lambda: r.choice([1e-7, 1e23, -1e23, 1e-310]), lambda: r.choice([None, math.nan, 3.5]), lambda: round(r.uniform(1e9, 9e14), 3)]
    for f in range(3):
        for _ in range(40):
            width = 12 if f < 2 else r.choice([11, 12])
            rows.append((f"file{f}", [kinds[i % len(kinds)]() for i in range(width)]))
    rows += [("file0", None), ("file9", []), ("file1", [math.inf] + [0.25] * 11), (None, [2.0**40, 1e15, 1e300])]
    return rows


@pytest.mark.parametrize("at_once", [1 << 20, 30])
def test_wide_partials_equal_the_profile_of_cells(spark, monkeypatch, at_once):
    monkeypatch.setattr(wide_profile, "AT_ONCE", at_once)
    df = spark.createDataFrame(wide_rows(3), "file string, values array<double>").coalesce(4)
    for keys in (["pos"], ["file", "pos"]):
        want = profiling.profile(profiling.wide_form(df), keys)
        got = wide_profile.profile_wide(df, tuple(keys))
        assert got.columns == want.columns
        assert sorted((str(tuple(x)) for x in got.collect())) == sorted((str(tuple(x)) for x in want.collect()))


def test_wide_sums_are_the_nearest_double(spark):
    rows = wide_rows(5)
    got = {r.pos: r.total for r in wide_profile.profile_wide(spark.createDataFrame(rows, "file string, values array<double>").repartition(5)).collect()}
    for pos in range(1, 12):
        values = [v[pos] for _, v in rows if v and len(v) > pos and v[pos] is not None and not math.isnan(v[pos])]
        assert got[pos] == nearest(values), pos


def test_many_exponents_are_given_away(spark, monkeypatch):
    monkeypatch.setattr(wide_profile, "EXPONENTS", 3)
    rows = [("f", [math.ldexp(1 / 3, k), -math.ldexp(1 / 7, -k)]) for k in range(-400, 400, 7)]
    got = {r.pos: r.total for r in wide_profile.profile_wide(spark.createDataFrame(rows, "file string, values array<double>").coalesce(1)).collect()}
    assert got == {i: nearest([v[i] for _, v in rows]) for i in (0, 1)}
