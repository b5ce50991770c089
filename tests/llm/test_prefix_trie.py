"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from wideskein.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(node[-1][1].encode().split()) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) if children[node] else 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in children[node])
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(rebuilt[c]) == len(node))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(spark, rows):
    df = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_rows(seed, convs, hot):
    r, rows = random.Random(seed), []
    texts = ["hello there", "what is it", "a b  c", "", "ok\tthen \n yes", None, "Ünïcödé ß"]
    for c in range(-25, convs):
        if r.random() < 0.15:
            continue
        first = ("user", "hello there") if r.random() < 0.5 else ("user", r.choice(texts))
        turns = [first] + [(r.choice(["user", "assistant", None]), r.choice(texts[:4])) for _ in range(r.randint(0, 5))]
        for i, (role, text) in enumerate(turns):
            rows.append((c, None if i == 0 and r.random() < 0.3 else i, role, text))
    rows += [(40, i, "user", f"turn {i % 3}") for i in range(hot)]
    return rows


@pytest.mark.parametrize(("seed", "convs", "hot"), [(1, 80, 10), (2, 30, 150), (3, 5, 0)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, convs, hot):
    monkeypatch.setattr(trie, "STRETCH", 8)  # one conversation spans many stretches
    rows = some_rows(seed, convs, hot)
    assert made(spark, rows) == brute(rows)


def test_odd_tables(spark):
    odd = [(None, 1, "user", "lost"), (7, None, None, None), (7, None, "user", "second of the null turns"), (7, 3, "user", "x"), (7, 3, "user", "x"), (1, 0, "", ""), (21, 5, "a", "bc"), (22, 5, "ab", "c"), (20, 1, "user", "w " * 30_000)]
    assert made(spark, odd) == brute(odd)
    assert made(spark, odd + odd) == brute(odd + odd)
    assert spark.createDataFrame([], SCHEMA).count() == 0 and made(spark, []) == []
    extra = spark.createDataFrame([(*r, 1, "k") for r in odd], SCHEMA + ", depth int, words string")
    assert sorted((tuple(r) for r in trie.prefix_trie(extra).collect()), key=str) == brute(odd)


def test_many_conversations_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 50)
    rows = [(20 * i, 1, "user", "the same") for i in range(700)] + [(20 * i + 1, 1, "user", "hello") for i in range(60)]
    assert made(spark, rows) == brute(rows)


def test_fingerprints_compose():
    p, b = trie.PRIMES[0], trie.BASES[0]
    exponents = np.array([0, 1, 2, 5, 4096, 10**9])
    assert trie._power(b, exponents, p).tolist() == [pow(b, int(e), p) for e in exponents]


def test_colliding_keys_are_found_and_made_again(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = some_rows(4, 40, 0)
    keyed = trie._keyed

    def poor(conversations, seed):
        turns = keyed(conversations, seed)
        return turns.withColumns({"k0": F.col("k0") % 3, "k1": F.lit(0).cast("long")}) if seed == 17 else turns

    monkeypatch.setattr(trie, "_keyed", poor)
    assert made(spark, rows) == brute(rows)
    with pytest.raises(RuntimeError):
        trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), seeds=(17,))
