"""Near copies by two-word shingles, and the search within a posting, against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wideskein.llm import exact_dedup, near_copies
from wideskein.llm.near_copies import Rule
from wideskein.llm.queries import OP12_RULE


def two_word_set(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws)} if len(ws) == 1 else {tuple(ws[i : i + 2]) for i in range(len(ws) - 1)}


def roots(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def brute(rows):
    sets = [two_word_set(t) for _, t in rows]

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)

    found, low = roots(len(rows), linked), defaultdict(list)
    for r, (d, _) in zip(found, rows, strict=True):
        low[r].append(d)
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in low.items()}
    return Counter((d, len(s), d if not s else least[r], d == (d if not s else least[r])) for (d, _), s, r in zip(rows, sets, found, strict=True))


def planted(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    rows = []
    for base in range(12):
        words = [r.choice(vocabulary) for _ in range(r.choice([3, 6, 12, 40, 150]))]
        for _ in range(9):
            copy = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 12))):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append((len(rows) + 100 * (base % 3), " ".join(copy)))
    return rows


def run(docs, **limits):
    made = near_copies.near_duplicates(docs, OP12_RULE, **limits)
    assert made.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return Counter(tuple(r) for r in made.collect())


@pytest.mark.parametrize("limits", [{}, {"short": 2, "held": 200}])
def test_components_equal_brute_force(spark, docs, rows, empty, limits):
    assert run(docs, **limits) == brute([(d, t) for d, t, *_ in rows])
    made = planted(5)
    got = run(spark.createDataFrame(made, "doc_id long, text string").repartition(5), **limits)
    assert got == brute(made) and len({c for _, _, c, _ in got}) < 80
    if not limits:
        assert run(empty) == Counter()


def some_sets(rng, kind):
    if kind == "random":
        return [np.unique(rng.integers(0, 60, int(rng.integers(0, 40)), dtype=np.uint64)) for _ in range(60)]
    core, own = np.arange(100, dtype=np.uint64), 1000
    sets = [core]
    for i in range(60):  # each near the core, most not near each other
        lost = int(rng.integers(5, 13))
        mine = np.arange(own + 100 * i, own + 100 * i + lost, dtype=np.uint64)
        sets.append(np.unique(np.concatenate([np.delete(core, rng.choice(100, lost, replace=False)), mine])))
    return sets if kind == "star" else sets[1:]


@pytest.mark.parametrize("kind", ["random", "star", "template"])
@pytest.mark.parametrize("percent", [50, 80, 95])
def test_search_within_a_posting(kind, percent):
    rng = np.random.default_rng(percent)
    for empty_linked in (True, False):
        sets, rule = some_sets(rng, kind), Rule(percent=percent, empty_linked=empty_linked)
        labels = rng.integers(0, 50, len(sets))
        want = [set(s.tolist()) for s in sets]

        def linked(i, j, want=want, labels=labels, rule=rule):
            if labels[i] == labels[j]:
                return True
            if not want[i] and not want[j]:
                return rule.empty_linked
            both = len(want[i] & want[j])
            return both and 100 * both >= rule.percent * (len(want[i]) + len(want[j]) - both)

        found = near_copies.within(sets, labels, rule)
        pairs = {frozenset(x) for x in found}
        assert len(found) < len(sets) and all(linked(i, j) for i, j in found)
        assert roots(len(sets), lambda i, j: labels[i] == labels[j] or frozenset((i, j)) in pairs) == roots(len(sets), linked)


def template(n, seed=1):
    """Texts that share about 83 of 100 words in a row of their own places: a likeness of about 0.7 to each other, links to none."""
    r = random.Random(seed)
    return [(i, " ".join(f"t{k}" if k % 6 else f"own{i}x{r.randrange(10**9)}" for k in range(120))) for i in range(n)]


def test_a_template_is_searched_in_proportion(spark):
    """Likeness 0.7 by single words: no two are linked; what is searched grows as the texts do, even where postings are long."""
    rule, searched = Rule(width=1, percent=80), {}
    for n in (150, 600):
        docs = spark.createDataFrame(template(n), "doc_id long, text string").repartition(4)
        rows = near_copies.banded(docs, rule)
        postings, members = near_copies._postings(rows)
        assert near_copies.links(docs, rule, short=64, rows=rows).count() == 0
        sizes = rows.select("text_hash", "n_shingles")
        left = near_copies._classed(members, spark.createDataFrame([], "a long, b long"), sizes)
        searched[n] = near_copies._blocks(left, near_copies.HELD).count()
    assert 0 < searched[600] <= 6 * searched[150] and searched[600] <= near_copies.BANDS * 600


def test_prefix_filter_does_not_square_a_template(monkeypatch):
    rule, compared = Rule(width=1, percent=80), []
    linked = Rule.linked
    monkeypatch.setattr(Rule, "linked", lambda self, shared, a, b: compared.append(len(b)) or linked(self, shared, a, b))
    for n in (200, 800):
        sets = [rule.shingles(t) for _, t in template(n)]
        assert near_copies.within(sets, np.arange(n), rule) == []
    assert sum(compared) == 0
    core = " ".join(f"t{k}" for k in range(120))
    sets = [rule.shingles(core)] + [rule.shingles(" ".join(f"t{k}" if k % 10 else f"own{i}x{k}" for k in range(120))) for i in range(400)]
    assert len(near_copies.within(sets, np.arange(401), rule)) == 400  # each is near the core, none near another


def test_signatures_of_linked_sets_agree():
    rng = np.random.default_rng(3)
    for _ in range(40):
        a = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))
        b = np.unique(np.concatenate([a[44:], rng.integers(0, 2**63, 44, dtype=np.uint64)]))
        x, y = (np.frombuffer(near_copies.signature(s), np.uint8) for s in (a, b))
        assert near_copies.MATCH <= (x == y).sum()
    assert near_copies.signature(a[:0]) == bytes(128)


def test_hot_leader_is_salted(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "A_LEADER", 7)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[: i % 60], f"e{i}", *base[i % 60 + 1 :]])) for i in range(150)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_exact_copies_are_decided_in_narrow_rows(spark, monkeypatch, limit):
    """Also with more keys and groups than are broadcast, a group with a third of all rows, and rows of no group."""
    monkeypatch.setattr(exact_dedup, "BROADCAST_KEYS", limit)
    rows = [(i, "hot text " * 30) for i in range(300)] + [(299, "hot text " * 30)] * 3 + [(1000 + i, f"pair {i // 2} of texts") for i in range(200)]
    rows += [(2000 + i, f"single {i} text") for i in range(390)] + [(None, "single 3 text"), (None, "pair 4 of texts"), (None, None), (5, None), (6, "")]
    kept = exact_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    best = {}
    for d, t in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if d is None else d)
    assert Counter((r.doc_id, r.text or "") for r in kept) == Counter((d if d >= 0 else None, t) for t, d in best.items())


def test_the_pipeline_stage_follows_fingerprints_and_shingles(spark):
    """Texts that SimHash links, though few of their shingles agree, and near copies that it does not link; a group is what both connect."""
    import corpus_pipeline
    from wideskein.llm import simhash

    tail = lambda name: " ".join(f"{name}{i}" for i in range(12))
    body = " ".join(f"w{i}" for i in range(60))
    one, two = "ab cd ef " * 100 + tail("p"), "ab cd ef " * 100 + tail("q")
    near = [body, body.replace("w30", "other")]
    chain = ["gh ij kl " * 100 + tail("r"), "gh ij kl " * 100 + " ".join(f"s{i}" for i in range(60)), "gh ij kl " * 100 + " ".join(f"s{i}" for i in range(60)) + " s60"]
    texts = [one, two, *near, *chain, "alone it stands here", None, " "]
    bits = lambda a, b: (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count()
    assert bits(one, two) <= 3 < bits(*near) and bits(*chain[:2]) <= 3
    docs = spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert sorted(r.doc_id for r in stage(spark, docs, "").collect()) == [1, 3, 5, 8, 9]
