"""The corpus operators against brute force, on small tables full of odd rows."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
import xxhash
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from wideskein.llm import components, exact_dedup, langid, mixing, near_copies, packing, recompression, secrets, sharding, simhash, sketches, toxicity
from wideskein.llm.common import bucket_count, cut, gapless_position, passing, running_total

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall((text or "").encode())


def test_bucketed_positions_and_totals(spark):
    df = spark.range(500).select(F.when(F.col("id") < 400, "hot").otherwise("cold").alias("g"), "id", (F.col("id") % 7).alias("v"))
    got = gapless_position(df, "g", ["id"], "at", bucket_count(F.when(F.col("g") == "hot", 400).otherwise(100), 20)).collect()
    for g, n in (("hot", 400), ("cold", 100)):
        assert sorted(r["at"] for r in got if r.g == g) == list(range(n))
    got = running_total(df, ["g"], ["id"], "v", "before", bucket_count(500, 20)).collect()
    for g in ("hot", "cold"):
        mine = sorted((r.before, r.v) for r in got if r.g == g)
        at = 0
        for before, v in sorted(mine, key=lambda x: (x[0], x[1] != 0)):
            assert before == at
            at += v


# 1


def test_passing_tables_belong_to_their_thread_and_go_after_an_error(spark):
    alive = lambda table: os.path.exists(table.inputFiles()[0].removeprefix("file://"))
    with ThreadPoolExecutor(1) as other, pytest.raises(KeyError):
        with passing(spark):
            mine, kept = cut(spark.range(3), "mine"), cut(spark.range(3), "kept", keep=True)
            theirs = other.submit(cut, spark.range(3), "theirs").result()
            files = mine.inputFiles()
            raise KeyError
    assert not os.path.exists(files[0].removeprefix("file://")) and alive(theirs) and alive(kept)


def test_knapsack_and_columns_reach_the_bound():
    values, sizes = np.array([1.0, 2.5, 4.0]), np.array([2, 3, 5])
    worth, patterns = packing.best_patterns(values, sizes, 11)
    assert worth == 9.0 and all(p[i] for p, i in zip(patterns, [2, 1, 0], strict=True))
    assert patterns[0] @ values == worth and (patterns @ sizes <= 11).all()
    rng = np.random.default_rng(1)
    histogram = np.bincount(rng.integers(0, 60, 4000), minlength=64)
    plan = packing.plan(histogram.tolist(), 64)
    used = Counter()
    for times, p in plan:
        assert sum((i + 1) * n for i, n in p) <= 64
        for i, n in p:
            used[i] += times * n
    assert all(used[i] == n for i, n in enumerate(histogram))
    bound = ((np.arange(64) + 1) * histogram).sum() / 64
    assert sum(t for t, _ in plan) <= bound * 1.05 + 2
    assert packing.plan([0] * 64, 64) == []


@pytest.mark.parametrize(("low", "high"), [(0, 480), (100, 500), (130, 256)])
def test_planner_ends_within_a_session(spark, monkeypatch, low, high):
    """Hundreds of classes, and bases inverted anew on the way, without help of linear algebra libraries."""
    rng, spark_rows = np.random.default_rng(low), spark.range(10).count()
    monkeypatch.setattr(packing, "REFRESH", 40)
    histogram = np.bincount(rng.integers(low, high, 60_000), minlength=512)
    plan = packing.plan(histogram.tolist(), 512)
    used = np.zeros(512, dtype=np.int64)
    for times, p in plan:
        assert sum((i + 1) * n for i, n in p) <= 512
        for i, n in p:
            used[i] += times * n
    assert (used == histogram).all() and spark_rows == 10
    _, amounts = packing.generate_columns(histogram[low:high].astype(float), np.arange(low, high) + 1, 512)
    assert amounts.sum() - 1e-6 <= sum(t for t, _ in plan) <= amounts.sum() * 1.003 + 2


def test_inverse():
    matrix = np.random.default_rng(1).normal(size=(60, 60))
    assert np.allclose(packing._inverse(matrix) @ matrix, np.eye(60))


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_covers_every_id_once(spark, docs, rows, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    out = packing.pack_documents(docs, capacity=capacity).collect()
    want = defaultdict(Counter)
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for at in range(0, len(ids), capacity):
            part = ids[at : at + capacity]
            want[doc_id][at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    got = defaultdict(Counter)
    for r in out:
        got[r.doc_id][r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    assert got == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in out)
    assert len(sequences) * capacity <= total * 1.15 + capacity


def test_sequences_round_trip(spark, rows):
    docs = spark.createDataFrame([r for r in rows if r[0] is not None and r[0] < 200][:40], "doc_id long, text string, lang string, source string, n_chars long").dropDuplicates(["doc_id"])
    packed = packing.pack_documents(docs, capacity=256)
    filled = {r.sequence_id: r.ids for r in packing.sequences(docs, packed).collect()}
    for r in packed.collect():
        part = np.array(filled[r.sequence_id][r.offset : r.offset + r.length], dtype="<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32


# 2


def test_sharding(spark, docs, rows):
    out, slot_map = sharding.shard_documents(docs, 4)
    got = out.collect()
    assert len(got) == len(rows)
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    for shard in range(4):
        mine = sorted(r.slot for r in got if r.shard == shard)
        assert mine == list(range(len(mine)))
    table = slot_map.table(spark)
    assert sharding.SlotMap.load(table).versions == slot_map.versions


def test_stored_maps_grow_and_spread(spark, tmp_path):
    path = str(tmp_path / "map")
    docs = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    first, slot_map = sharding.shard_documents(docs, 4, path)
    loads = [r.n for r in first.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(loads) == 4 and max(loads) - min(loads) <= 0.01 * max(loads)
    before = {(r.doc_id, r.text_crc32): r.shard for r in first.collect()}
    assert sharding.shard_documents(docs, 4, path)[1].versions == slot_map.versions
    after, grown = sharding.shard_documents(docs, 5, path)
    moved = [r.shard for r in after.collect() if before[r.doc_id, r.text_crc32] != r.shard]
    assert moved and set(moved) == {4} and 0.8 * 1200 < len(moved) < 1.2 * 1200
    assert grown.versions[0] == slot_map.current and sharding.stored(spark, path).versions == grown.versions
    more = docs.unionByName(spark.range(200).select(F.lit(7).cast("long").alias("doc_id"), F.lit("heavy").alias("text")))
    assert len(sharding.shard_documents(more, 5, path)[1].versions) >= 2


def test_slot_maps_move_only_what_they_must():
    rng = np.random.default_rng(2)
    sizes = {s: int(x) for s, x in enumerate(rng.integers(1, 1000, 2000))}
    first = sharding.SlotMap.balanced(sizes, 24, 2000)
    load = Counter()
    for s, n in sizes.items():
        load[first.current[s]] += n
    assert max(load.values()) - min(load.values()) <= 1000
    grown = first.grow(sizes)
    moved = [(a, b) for a, b in zip(first.current, grown.current, strict=True) if a != b]
    assert moved and all(b == 24 for _, b in moved) and len(grown.versions) == 2
    changed = {s: n * (5 if first.current[s] == 0 else 1) for s, n in sizes.items()}
    evened = first.rebalance(changed)
    load = Counter()
    for s, n in changed.items():
        load[evened.current[s]] += n
    mean = sum(load.values()) / 24
    assert max(load.values()) < 1.1 * mean


# 3


def test_exact_dedup(spark, docs, rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[t or ""].append(d)
    keep = {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    want = Counter((d, keep[t or ""], len(groups[t or ""]), d == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for d, t, *_ in rows)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.mark(docs).collect())
    assert got == want
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == Counter({(keep[t], t): 1 for t in groups})
    assert {k: v for k, v in Counter(r.text_sha256 for r in exact_dedup.duplicate_groups(docs).collect()).items() if v > 1} == {}


def test_exact_dedup_without_broadcast(spark, docs, monkeypatch):
    a = Counter(map(tuple, exact_dedup.mark(docs).collect()))
    monkeypatch.setattr(exact_dedup, "BROADCAST_KEYS", -1)
    assert Counter(map(tuple, exact_dedup.mark(docs).collect())) == a


# 4


def test_language_id(spark):
    import random

    r = random.Random(5)
    parts = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["str", "ong", "eth", "wh"], "zz": ["é", "eau", "ou", "ç"]}
    rows = [(i, " ".join("".join(r.choice(parts[lang]) for _ in range(3)) for _ in range(r.randint(3, 60))), lang) for i in range(600) for lang in [["xx", "yy", "zz"][i % 3]]]
    rows += [(1000, None, "xx"), (1001, "12 34 !", "yy"), (1002, "", None), (1003, "kalomi tuka", None), (None, "strong etheth whstr", "yy"), (1003, "kalomi tuka", None)]
    out = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=200).collect()
    assert len(out) == len(rows)
    truth = {d: lang for d, _, lang in rows}
    held = [o for o in out if o.held_out and o.doc_id is not None and o.doc_id < 600]
    assert all(o.held_out == (zlib.crc32(str(o.doc_id).encode()) % 5 == 0) for o in out if o.doc_id is not None)
    assert sum(o.lang_pred == truth[o.doc_id] for o in held) >= 0.97 * len(held) > 60
    by = {o.doc_id: o for o in out}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert by[1003].lang_pred == "xx" and by[None].lang_pred == "yy" and all(0 <= o.score <= 1 for o in out)


def brute_grams(text, dimensions):
    """Features of all runs of one to three characters, one by one."""
    clean, out = " " + re.sub(r"[\W\d_]+", " ", text.lower()) + " ", []
    for width in (1, 2, 3):
        for i in range(len(clean) - width + 1):
            h = 0
            for j in range(width):
                h = (h + ord(clean[i + j]) + j + 1) * 2654435761 % 2**32
                h ^= h >> 15
            out.append(h % dimensions)
    return out


def test_language_scores_follow_from_counts_weights_and_temperature(spark, docs, rows, monkeypatch):
    """TF-IDF, logits, temperature and probabilities again from plain counts; odd, long, repeated rows and extra columns among them."""
    seen = {}

    def learned(*args, made=langid.ftrl):
        seen["w"] = made(*args)
        return seen["w"]

    def cooled(logits, labels, made=langid.temperature):
        seen["t"], seen["checks"] = made(logits, labels), (logits, labels)
        return seen["t"]

    monkeypatch.setattr(langid, "ftrl", learned)
    monkeypatch.setattr(langid, "temperature", cooled)
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 0
    trainable = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) != 0
    model = langid.fit(docs, trainable, dimensions=512)
    got = Counter((r.doc_id, r.lang_pred, round(r.score, 4)) for r in langid.predict(docs, model).collect())
    w, t = seen["w"], seen["t"]
    train = [x for d, x, lang, *_ in rows if x is not None and lang is not None and not held(d)]
    present = Counter(f for x in train for f in set(brute_grams(x, 512)))
    idf = [math.log((1 + len(train)) / (1 + present[f])) + 1 for f in range(512)]
    languages = sorted({lang for d, x, lang, *_ in rows if x is not None and lang is not None and not held(d)})
    want = []
    for d, x, *_ in rows:
        if not x or not any(c.isalpha() for c in x):
            want.append((d, {"und": 0.0}))
            continue
        grams = Counter(brute_grams(x, 512))
        logits = [(w[512, c] + sum(n / grams.total() * idf[f] * 20 * w[f, c] for f, n in grams.items())) / t for c in range(len(languages))]
        odds = [math.exp(z - max(logits)) for z in logits]
        want.append((d, {lang: o / sum(odds) for lang, o in zip(languages, odds, strict=True)}))
    left = Counter(got)
    for d, p in want:
        best = max(p.values())
        hit = next(k for k in left if left[k] and k[0] == d and abs(k[2] - best) < 2e-3 and p.get(k[1], -1) > best - 2e-3)
        left[hit] -= 1
    assert not +left and len(model.languages) == len(languages)
    logits, labels = seen["checks"]
    assert len(labels) >= 10

    def loss(x):
        z = logits / x
        z = z - z.max(axis=1, keepdims=True)
        return -(z[np.arange(len(labels)), labels] - np.log(np.exp(z).sum(axis=1))).mean()

    assert loss(t) <= min(loss(x) for x in np.geomspace(0.05, 20, 400)) + 1e-6


def test_ftrl_equals_a_scalar_form():
    rng = np.random.default_rng(2)
    rows = [(int(rng.integers(3)), np.sort(rng.choice(9, 3, replace=False)), rng.random(3)) for _ in range(40)]
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.1
    z, n = defaultdict(float), defaultdict(float)

    def weight(f, c):
        if abs(z[f, c]) <= l1:
            return 0.0
        return -(z[f, c] - math.copysign(l1, z[f, c])) / ((beta + math.sqrt(n[f, c])) / alpha + l2)

    order = np.random.default_rng(11)
    for _ in range(4):
        for i in order.permutation(len(rows)):
            label, at, x = rows[i]
            features = [*zip(at.tolist(), x.tolist(), strict=True), (9, 1.0)]
            before = {(f, c): weight(f, c) for f, _ in features for c in range(3)}
            odds = [math.exp(sum(v * before[f, c] for f, v in features)) for c in range(3)]
            for f, v in features:
                for c in range(3):
                    g = v * (odds[c] / sum(odds) - (c == label))
                    sigma = (math.sqrt(n[f, c] + g * g) - math.sqrt(n[f, c])) / alpha
                    z[f, c] += g - sigma * before[f, c]
                    n[f, c] += g * g
    assert np.allclose(langid.ftrl(rows, 9, 3), [[weight(f, c) for c in range(3)] for f in range(10)])


def test_language_id_without_labels(spark):
    out = langid.identify(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).collect()
    assert [(o.lang_pred, o.score) for o in out] == [("und", 0.0)]


# 5


def brute_fingerprint(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")))
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    bits = [0] * 64
    for x in s:
        h = xxhash.xxh64_intdigest(x, seed=42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if s and 2 * bits[b] > len(s))


def classes(values, near):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                parent[find(i)] = find(j)
    groups = defaultdict(set)
    for i in range(len(values)):
        groups[find(i)].add(values[i])
    return {frozenset(g) for g in groups.values()}


def test_near_duplicates(spark, docs, rows):
    got = simhash.near_duplicates(docs).collect()
    prints = {t: brute_fingerprint(t) for _, t, *_ in rows}
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((d, f"{prints[t]:016x}") for d, t, *_ in rows)
    groups = classes(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for g in groups:
        ids = [d for d, t, *_ in rows if prints[t] in g and d is not None]
        least |= {p: min(ids, default=None) for p in g}
    assert all(r.component_id == least[int(r.fingerprint, 16)] for r in got)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {x for x in least.values() if x is not None} | ({None} & set(least.values()))


def test_near_copies_without_ids_are_decided_by_row(spark):
    a, b, c = "red green blue black white", "one quite different clean text", "and another one of its own"
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c), (7, a), (7, "a clean row that shares its id")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, a), (None, b), (None, c), (7, rows[-1][1])])


@pytest.mark.parametrize(("short", "held"), [(2048, 10**6), (3, 10**6), (2, 900)])
def test_near_copies_of_five_word_shingles(spark, short, held):
    rng = np.random.default_rng(8)
    rows = [(0, None), (1, ""), (2, " \t"), (3, "One two"), (4, "one TWO"), (None, "clean text without an id")]
    for base in range(8):
        made = [f"w{x}" for x in rng.integers(0, 4000, int(rng.integers(40, 300)))]
        for _ in range(9):
            copy = list(made)
            for at in rng.integers(0, len(copy), int(rng.integers(1, 8))):
                copy[at] = f"e{rng.integers(0, 10**6)}"
            rows.append((100 * base + len(rows), " ".join(copy)))
    cut5 = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = {t: cut5((t or "").lower().split()) for _, t in rows}
    alike = lambda a, b: sets[a] == sets[b] or 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    want = set()
    for group in classes(list(sets), alike):
        ids = [d for d, t in rows if t in group]
        want.add(min((d for d in ids if d is not None), default=None))
    kept = [r.doc_id for r in near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), None, short, held).collect()]
    assert Counter(kept) == Counter(want) and 8 < len(want) < 70


def test_a_large_group_of_near_copies_is_connected_by_its_leaders(spark):
    rng = np.random.default_rng(2)
    base = [f"w{x}" for x in rng.integers(0, 4000, 120)]
    rows = []
    for i in range(300):
        copy = list(base)
        copy[int(rng.integers(0, 120))] = f"e{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(f"v{x}" for x in rng.integers(0, 4000, 60))) for i in range(40)]
    docs, rule = spark.createDataFrame(rows, "doc_id long, text string"), near_copies.Rule()
    bands = near_copies.banded(docs, rule)
    postings, members = near_copies._postings(bands)
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text")
    sets = texts.mapInArrow(near_copies._with_sets(rule), "text_hash long, signature binary, found array<long>").cache()
    pairs = near_copies._leading(postings, members).cache()
    stars = near_copies.confirmed(pairs, sets, rule).cache()
    assert pairs.count() <= 3 * 340 and 299 <= stars.count() <= 3 * 300
    assert near_copies._classed(members, stars, bands.select("text_hash", "n_shingles")).count() == 0
    kept = near_copies.keep_one(docs, None, 16, 100).collect()
    assert sorted(r.doc_id for r in kept) == [0, *range(1000, 1040)]


@pytest.mark.parametrize(("dense", "hot_share"), [(4096, 512), (6, 512), (6, 3), (3, 10**9)])
def test_links_of_dense_clusters(spark, dense, hot_share):
    rng = np.random.default_rng(4)
    base = [int(x) for x in rng.integers(0, 2**63, 6)]
    values = {b for b in base}
    for b in base[:3]:
        for _ in range(25):
            x = b
            for bit in rng.integers(0, 64, int(rng.integers(1, 6))):
                x ^= 1 << int(bit)
            values.add(x)
    values = sorted(values)
    df = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    found = components.components(simhash.links(df, dense, hot_share)).collect()
    groups = defaultdict(set)
    for r in found:
        groups[r.root].add(r.node % 2**64)
    want = {g for g in classes(values, lambda a, b: (a ^ b).bit_count() <= 3) if len(g) > 1}
    assert {frozenset(g) for g in groups.values()} == want


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}


# 6


def brute_kept(rows, window=13):
    seen = defaultdict(lambda: None)
    lists = [(d, words(t)) for d, t, *_ in rows]
    for d, w in lists:
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i : i + window])
                seen[k] = d if seen[k] is None else min(seen[k], d)
    out = Counter()
    for d, w in lists:
        cover = [False] * len(w)
        if d is not None:
            for i in range(len(w) - window + 1):
                if seen[tuple(w[i : i + window])] < d:
                    cover[i : i + window] = [True] * window
        kept = b" ".join(x for x, c in zip(w, cover, strict=True) if not c)
        out[d, len(w), sum(cover), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("limits", [{}, {"broadcast_triples": 0, "broadcast_names": 0, "broadcast_ranges": 0}])
def test_repeated_windows_are_removed(spark, docs, rows, limits):
    got = Counter(map(tuple, recompression.kept_digests(docs, **limits).collect()))
    assert got == brute_kept(rows)


def test_repeats_of_other_widths_and_texts(spark, docs, rows):
    got = Counter(map(tuple, recompression.kept_digests(docs, window=5).collect()))
    assert got == brute_kept(rows, 5)
    cleaned = recompression.remove_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    by = {(r.doc_id, r.n_words): r.kept_sha256 for r in recompression.kept_digests(docs).collect()}
    for r in cleaned.where("doc_id < 9000").collect():
        assert hashlib.sha256(b" ".join(words(r.text))).hexdigest() in by.values()


def test_equal_words_have_equal_representatives():
    rng = np.random.default_rng(8)
    for window, vocabulary in ((13, 4), (13, 50), (41, 3)):
        core = [f"w{x}" for x in rng.integers(0, vocabulary, window)]
        names = set()
        for _ in range(30):
            left, right = ([f"w{x}" for x in rng.integers(0, vocabulary, 20)] for _ in range(2))
            b = recompression.Batch([" ".join(left + core + right), " ".join(core), " ".join([*core, "w1"])])
            starts = np.array([20, 40 + window, 40 + 2 * window])
            names |= set(b.representatives(starts, window).tolist())
        assert len(names) == 1


def test_runs_and_pairs_shrink_a_text():
    b = recompression.Batch([" ".join(["so"] * 1000), " ".join(f"w{i % 9}" for i in range(3000)), "", "one"])
    sizes = [len(b.high(r)) for r in range(12)]
    assert sizes[0] == 4001 and sizes[1] < 3002 and all(x >= y for x, y in zip(sizes, sizes[1:], strict=False)) and sizes[8] < 500


# 7


def test_edits_and_neighbours(spark, rows):
    unique = list({r[0]: r for r in rows}.values())
    out = {r.doc_id: r for r in sketches.fingerprint_edits(spark.createDataFrame(unique, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert len(out) == len(unique)
    order = sorted(unique, key=lambda r: (r[0] is None, -(r[0] or 0)))
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [words(t)] for i in range(max(1, len(w) - 4))} if words(t) else set()
    errors = []
    for i, (d, t, *_) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        third = len(t) // 3
        changed = t[: len(t) - third] + following[:third]
        assert out[d].n_chars == len(t)
        assert out[d].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        for near, other in ((out[d].near_edited, changed), (out[d].near_next, following)):
            a, b = shingles(t), shingles(other)
            errors.append(abs(near - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert max(errors) < 0.2 and np.mean(errors) < 0.02
    same = defaultdict(set)
    for d, t, *_ in unique:
        same[t or ""].add(out[d].fingerprint)
    assert all(len(s) == 1 for s in same.values())


def test_hot_and_missing_ids_are_split_into_ranges(spark, docs, monkeypatch):
    monkeypatch.setattr(sketches, "RANGE_BYTES", 400)
    rows = [(None if i % 3 == 0 else 77 if i % 3 == 1 else i, f"text {i} " + "w " * (i % 40)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"tie": F.lit(0), "range": F.lit("x"), "guest": F.lit(5)})
    sizes = Counter(r.range for r in sketches._ranged(df)[0].collect())
    assert max(sizes.values()) < 60 and len(sizes) > 20
    tie = {r.text: r.tie for r in sketches._ranged(df)[0].collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), tie[r[1]]))
    got = Counter((r.doc_id, r.edited_sha256) for r in sketches.fingerprint_edits(df).collect())
    want = Counter((d, hashlib.sha256(sketches.edited(t, order[(i + 1) % 600][1]).encode()).hexdigest()) for i, (d, t) in enumerate(order))
    assert got == want
    assert sketches.fingerprint_edits(docs).count() == docs.count()


def test_sketches_merge_and_estimate(spark, docs, empty):
    a, b = np.arange(1, 9000, dtype=np.uint64), np.arange(3000, 12000, dtype=np.uint64)
    x, y = sketches.sketch(sketches.mix(a)), sketches.sketch(sketches.mix(b))
    union = sketches.sketch(sketches.mix(np.union1d(a, b)))
    assert (sketches.merge(x, y) == union).all()
    assert abs(sketches.resemblance(x, y) - 0.5) < 0.15 and abs(sketches.containment(x, y) - 2 / 3) < 0.2
    assert abs(sketches.distinct(x) / 9000 - 1) < 0.3
    assert (sketches.from_text(sketches.to_text(x)) == x).all()
    made = sketches.document_sketches(docs)
    whole = sketches.merged_sketches(made.withColumn("part", F.col("doc_id") % 3), "part")
    assert whole.count() == 4 and made.count() == docs.count()


def test_one_row_and_ties(spark):
    one = sketches.fingerprint_edits(spark.createDataFrame([(5, "a b c d e f g")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    twice = sketches.fingerprint_edits(spark.createDataFrame([(5, "a b c d e f g")] * 2, "doc_id long, text string"))
    assert twice.count() == 2


# 8


@pytest.fixture(scope="module")
def labelled(spark):
    import random

    r = random.Random(6)
    clean = ["".join(r.choice("bcdfglmnr") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(300)]
    docs, labels = [], []
    for i in range(500):
        text = [r.choice(clean) for _ in range(r.randint(5, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(r.randint(1, 5)):
                text.insert(r.randint(0, len(text)), r.choice(["Vilest", "horrid!", "SCUM", "zorgak" + r.choice(clean)]))
        docs.append((i, " ".join(text), toxic))
        if i % 2 == 0:
            labels.append((i, None, int(toxic)))
    labels += [(9999, 1, 1), (None, 1, 1), (3, 1, None)]
    return docs, labels


def test_toxicity(spark, labelled):
    docs, labels = labelled
    df = spark.createDataFrame([(d, t) for d, t, _ in docs] + [(777, None), (778, ""), (None, "scum " * 9)], "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert list(model.thresholds) == sorted(model.thresholds)
    out = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    truth = {d: t for d, _, t in docs}
    unseen = [d for d in truth if d % 2]
    caught = [d for d in unseen if truth[d] and out[d].toxic]
    wrong = [d for d in unseen if not truth[d] and out[d].toxic]
    assert len(caught) >= 0.9 * sum(truth[d] for d in unseen) and len(wrong) <= 4
    assert not out[777].toxic and not out[778].toxic and out[None].toxic
    assert all(0 <= r.severity <= 3 for r in out.values())
    kept = toxicity.keep_clean(df.withColumn("toxic", F.lit("column")), model)
    assert {r.doc_id for r in kept.collect()} == {d for d, r in out.items() if not r.toxic}


def test_toxicity_scores_follow_from_the_model(spark, docs, rows):
    """Every probability again from weights and thresholds, features counted anew; odd, long and repeated rows among them."""
    weights = {"so": 0.4, "so+": 1.5, "^w12": -0.7, "row": 2.0, "^with": 0.3, "a": 0.2, "one": -1.0}
    model = toxicity.Model(weights, np.array([0.5, 1.0, 2.5]))

    def evidence(text):
        seen = Counter(f for w in re.findall(r"[^\W\d_]+", (text or "").lower()) for f in [w, *("^" + w[:n] for n in (4, 5, 6, 7) if len(w) > n)])
        return sum(weights.get(f, 0) + (weights.get(f + "+", 0) if n > 1 else 0) for f, n in seen.items())

    want = Counter()
    for d, t, *_ in rows:
        p = [1 / (1 + np.exp(x - evidence(t))) for x in (0.5, 1.0, 2.5)]
        want[d, round(sum(p), 9), round(p[0], 9), bool(p[0] >= 0.5)] += 1
    assert Counter((r.doc_id, round(r.severity, 9), round(r.p_toxic, 9), r.toxic) for r in toxicity.score(docs, model).collect()) == want
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter({d: n for d, n in Counter(k[0] for k in want.elements() if not k[3]).items()})


def test_grades_come_from_models_of_other_folds():
    rng = np.random.default_rng(3)
    toxic = np.array([i % 2 for i in range(400)])
    lists = [sorted({0} | set(rng.integers(1, 3, 1).tolist())) if t and rng.random() < 0.7 else [3] if t else [] for i, t in enumerate(toxic)]
    grades = toxicity._grades(lists, toxic, np.arange(400) // 2 % 4, 4)
    assert set(grades[toxic == 0]) == {0} and set(grades[toxic == 1]) <= {1, 2, 3} and grades.max() == 3


def test_toxicity_without_labels(spark, docs):
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert not any(r.toxic for r in toxicity.score(docs, model).collect())


def test_toxic_documents_with_held_out_labels_are_found(spark):
    """The tables' labels: learned from four fifths of them, held to the rest."""
    folder = "/root/testdata/sf0.1"
    if not os.path.exists(folder):
        pytest.skip("test tables are not here")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where("doc_id % 5 <> 0"))
    found = toxicity.score(docs, model).join(labels.where("doc_id % 5 = 0 and toxic is not null").select("doc_id", F.col("toxic").alias("truth")), "doc_id")
    n = Counter((r.truth, r.toxic) for r in found.select("truth", "toxic").collect())
    assert n[1, True] + n[1, False] >= 50 and n[1, True] >= 0.9 * (n[1, True] + n[1, False])
    assert n[0, True] <= 0.01 * (n[0, True] + n[0, False])


# 9


def test_apportionment():
    assert mixing.sainte_lague([53, 24, 23], 7, [9, 9, 9]) == [3, 2, 2]
    assert mixing.sainte_lague([1.0, 1.0], 3, [9, 9]) == [2, 1]
    assert mixing.sainte_lague([100.0, 1.0], 10, [4, 9]) == [4, 6]
    assert mixing.sainte_lague([0.0, 0.0], 5, [1, 1]) == [0, 0]
    votes, seats = [412.0, 97.0, 33.0, 20.0, 4.0], 50
    got = [0] * 5
    for _ in range(seats):
        got[max(range(5), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    assert mixing.sainte_lague(votes, seats, [99] * 5) == got
    fill = mixing.water_fill([10, 100, 0], [5, 2, 1], 165)
    assert fill[0] == 20 and abs(fill[1] - 145) < 1e-9 and fill[2] == 0


def level_targets(sizes):
    """Targets by a water level found by halving: 5, 2, 1 times the level, twice the size at most, 150 % of all sizes together."""
    weights, low, high = [[5, 2, 1][i % 3] for i in range(len(sizes))], 0.0, 4.0 * sum(sizes) + 1
    at = lambda level: [min(2.0 * s, level * w) for s, w in zip(sizes, weights, strict=True)]
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(at(middle)) < 1.5 * sum(sizes) else (low, middle)
    return at(high)


def test_mix_plan(spark, docs, rows):
    plan = mixing.mix_plan(docs).collect()
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    assert Counter((r.doc_id, r["size"]) for r in plan) == Counter((d, len(words(t))) for d, t, *_ in rows)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, level_targets([sizes[s] for s in order]), strict=True))
    taken = Counter()
    for r in plan:
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.01 * targets[s] + 4
    again = mixing.mix_plan(docs.repartition(3)).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in plan)


def test_mixed_texts_hold_what_the_plan_takes(spark, rows):
    docs = spark.createDataFrame(list({r[0]: r for r in rows}.values()), "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(words(r.text))
    assert got == Counter({r.doc_id: r.taken for r in mixing.mix_plan(docs).collect() if r.taken})


# 10


def test_coverage_takes_the_whole_candidate():
    language = secrets.Language(np.zeros((28, 28)), frozenset({"word", "path", "parts", "art"}))
    assert language.coverage("xpartsqwordword") == 13 / 15 and language.coverage("q" * 40) == 0
    at = secrets.FEATURES.index("coverage")
    for text, share in (("word/path/" * 26 + "q7Zx" * 135, 208 / 800), ("q7Zx" * 65 + "word" * 135, 540 / 800)):
        assert language.features(text, "token = ", "", "")[at] == share


def test_secret_scan(spark, rows):
    import random

    r = random.Random(9)
    filler = "the quick brown fox jumps over lazy dogs while reading books about rivers".split()
    found = []
    for i in range(240):
        text = [r.choice(filler) for _ in range(40)]
        key = "".join(r.choice("0123456789abcdef") for _ in range(40))
        kind = i % 4
        if kind == 0:
            text.insert(9, f'token = "{key}"')
        elif kind == 1:
            text.insert(9, "".join(r.choice(filler) for _ in range(5)))
        elif kind == 2:
            text.insert(9, "".join(r.choice("0123456789") for _ in range(20)))
        found.append((i, " ".join(text), None, "src/app.py", 1))
    docs = spark.createDataFrame(found + rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = secrets.scan(docs).collect()
    by = defaultdict(list)
    for o in out:
        by[o.doc_id].append(o)
        assert 0 <= o.score <= 1 and "*" in o.preview
    for i in range(240):
        assert [o.secret for o in by[i]] == [[True], [False], [False], []][i % 4]
    text = dict((d, t) for d, t, *_ in found)
    assert all(hashlib.sha256(text[o.doc_id][o.start : o.end].encode()).hexdigest() == o.sha256 for o in out if o.doc_id is not None and o.doc_id < 240 and o.doc_id % 4 == 0)
    found = secrets.candidates(docs, secrets.learn_language(docs)).cache()
    assert secrets.train(found, spark.createDataFrame([], "doc_id long, start long, label double")) is None
    none = secrets.classify(found, None)
    assert none.count() == len(out) and none.where("secret").count() == 0
    forest = secrets.train(found, secrets.label_findings(found))
    for r in secrets.classify(found, forest).limit(40).collect():
        votes = [np.array(tree.predictRaw(Vectors.dense(r.features))) for tree in forest.trees]
        assert abs(np.mean([v / v.sum() for v in votes], axis=0)[1] - r.score) < 1e-9


def test_candidates_of_all_kinds():
    get = lambda t: [t[a:b] for a, b in secrets.found_in(t)]
    assert get("plain words onlylonger but nothing-else") == []
    assert get("a key: hunter2pass, then 'passphrase' and url=abcdefgh.") == ["hunter2pass", "passphrase", "abcdefgh"]
    assert get("eyJhbGciOiJI.eyJzdWIi.SflKxwRJ: " + "k" * 16 + " short12") == ["eyJhbGciOiJI.eyJzdWIi.SflKxwRJ", "k" * 16]
    assert get("=" * 40 + " " + "-" * 9) == [] and get("") == []
    assert get("x" * 5000 + "9") == ["x" * 5000 + "9"]
    at = lambda t, c: secrets.place_of(t, t.index(c), t.index(c) + len(c))
    assert at('token = "abc123def456"', "abc123def456") == "quoted" and at("so abc123def456, then", "abc123def456") == "running"
    assert at('key: "your_key_12345"', "your_key_12345") == "placeholder" and at("k=abc123def456", "abc123def456") == "other"


def test_planted_secrets_of_unseen_documents_are_found(spark):
    """The tables' planted tokens; the forest learns from four fifths of the documents and is held to the rest."""
    sf = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(sf):
        pytest.skip("test tables are not here")
    docs = spark.read.parquet(sf)
    found = secrets.candidates(docs, secrets.learn_language(docs)).cache()
    forest = secrets.train(found, secrets.label_findings(found).where("doc_id % 2 = 0"))
    got = {(r.doc_id, r.sha256) for r in secrets.classify(found, forest).where("secret and doc_id % 2 = 1").collect()}
    planted = {(r.doc_id, hashlib.sha256(k.encode()).hexdigest()) for r in docs.where("doc_id % 2 = 1").collect() for k in re.findall(r'token = "([0-9a-f]{40})"', r.text or "")}
    hits = len(got & planted)
    assert planted and hits >= 0.9 * len(planted) and hits >= 0.9 * len(got)


# All


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert packing.pack_documents(empty).count() == 0
    assert sharding.shard_documents(empty, 3)[0].count() == 0
    assert exact_dedup.mark(empty).count() == 0 and exact_dedup.keep_one(empty).count() == 0
    assert langid.identify(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert recompression.kept_digests(empty).count() == 0
    assert sketches.fingerprint_edits(empty).count() == 0
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0
    assert mixing.mix_plan(empty).count() == 0 and mixing.apply_mix(empty).count() == 0
    assert secrets.scan(empty).count() == 0
