"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wideskein.llm import resampling
from wideskein.llm.common import in_order

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def features(text, low, high):
    ws = WORD.findall(lowered(text))
    return len(ws), [" ".join(ws[i : i + n]) for n in range(low, high + 1) for i in range(len(ws) - n + 1)]


def brute(rows, target, percent, least_words, low, high, size, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % size
    s = Counter(bucket(f) for _, t in rows for f in features(t, low, high)[1])
    t = Counter(bucket(f) for x in target for f in features(x, low, high)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((float(t[b] + 1) * float(big_s + size)) / (float(s[b] + 1) * float(big_t + size))))
    out = []
    for doc_id, text in rows:
        n, found = features(text, low, high)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = Counter()
    for i, r in enumerate(able):
        ranks[(r[0], r[2], r[3], r[4], i + 1 if i < percent * len(able) // 100 else None)] += 1
    for r in out:
        if r[1] < least_words:
            ranks[(r[0], r[2], r[3], r[4], None)] += 1
    return ranks


@pytest.mark.parametrize(("percent", "least_words", "low", "high", "size"), [(10, 20, 1, 1, 10_000), (35, 3, 1, 2, 64), (100, 0, 2, 3, 7), (0, 20, 1, 1, 10)])
def test_draw_equals_brute_force(spark, docs, rows, percent, least_words, low, high, size):
    target = ["Three words here", None, "", rows[5][1], rows[20][1], "ÄÖ ß 3a-b"]
    made = resampling.resample(docs, spark.createDataFrame([(i, x, 1) for i, x in enumerate(target)], "item_id long, text string, score int"), percent, least_words, low, high, size, 7)
    got = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in made.collect())
    want = brute([(d, t) for d, t, *_ in rows], target, percent, least_words, low, high, size, 7)
    assert got == want and made.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_long_texts_are_split_whole():
    f = resampling.Features(1, 2, 1000)
    text = "Abé, c1 \x00 d-e " * 500 + "x" * 5000 + " end"
    whole, parts = f.of(text), f.of(text, 64)
    assert whole[0] == parts[0] == len(WORD.findall(lowered(text))) and (whole[1] == parts[1]).all()
    assert f.of(None)[0] == 0 and len(f.of(" -- ")[1]) == 0


def test_empty_tables_and_targets(spark, docs, empty, rows):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(empty, none).collect() == []
    assert resampling.resample(empty, docs).collect() == []
    got = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in resampling.resample(docs, none, percent=50).collect())
    assert got == brute([(d, t) for d, t, *_ in rows], [], 50, 20, 1, 1, 10_000, 2024)


def test_rows_are_numbered_in_order_even_if_most_are_equal(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id") % 50).alias("v"), F.when(F.col("id") % 4 > 0, F.col("id")).alias("w")).repartition(7)
    got = in_order(df, [F.col("v").desc(), F.col("w").asc_nulls_last()], "at", "numbered").collect()
    assert sorted(r["at"] for r in got) == list(range(3000))
    placed = [(r.v, r.w) for r in sorted(got, key=lambda r: r["at"])]
    assert placed == sorted(placed, key=lambda x: (-x[0], x[1] is None, x[1] or 0))


def test_mostly_repeated_rows(spark):
    rows = [(4, "same words " * 12)] * 200 + [(i, f"other words {i} " * 8) for i in range(100)]
    got = resampling.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), spark.createDataFrame([("words",)], "text string"), percent=60)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()) == brute(rows, ["words"], 60, 20, 1, 1, 10_000, 2024)
