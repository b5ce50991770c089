"""The pipeline against its parts, and the registered queries."""

import os
import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from wideskein.llm import queries, toxicity
from wideskein.llm.common import cut

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def smallest_of_near_copies(texts):
    """By brute force: documents linked at a likeness of 0.8 of their lower-cased five-word shingles, one of each group."""
    cut5 = lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = {d: cut5(re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())) for d, t in texts.items()}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and (sets[a] == sets[b] or 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d for d in root if find(d) == d}


def test_odd_rows_pass_through_the_pipeline(spark, tmp_path, docs, empty):
    labels = "doc_id long, quality int, toxic int"
    for name, table in (("odd", docs), ("empty", empty)):
        base = str(tmp_path / name)
        table.write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame([], labels).write.parquet(f"{base}/labels.parquet")
        stage = spark.read.parquet(f"{base}/documents.parquet")
        for step, function in corpus_pipeline.STAGES[:-1]:
            stage = cut(function(spark, stage, base), f"odd-{step}")
            assert stage.columns == table.columns
        packed = corpus_pipeline.run(spark, base).collect()
        assert len(packed) >= stage.count() and bool(packed) == (name == "odd")


def test_every_registered_query_runs(spark):
    for name, query in queries.queries().items():
        assert query(spark, SF).count() >= (0 if name.startswith("op10") else 20 if name.startswith("op13") else 200), name
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_recompression_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    names = ["doc_id", "kept_sha256", "n_removed", "n_words"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.oracle_sql()['op6_recompression']}) ORDER BY 1").fetchall()
    assert [tuple(r) for r in queries.queries()["op6_recompression"](spark, SF).select(*names).orderBy("doc_id").collect()] == want


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "simhash_near_dedup", "mix_sources", "pack"]
    clean = stages["toxicity"](spark, docs, SF).cache()
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(docs, model).where("toxic").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad
    single = stages["exact_dedup"](spark, clean, SF).cache()
    last = {}
    for r in clean.collect():
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert sorted(r.doc_id for r in single.collect()) == sorted(last.values())
    near = stages["simhash_near_dedup"](spark, single, SF).cache()
    assert {r.doc_id for r in near.collect()} == smallest_of_near_copies({r.doc_id: r.text for r in single.collect()})
    mixed = stages["mix_sources"](spark, near, SF).cache()
    assert mixed.columns == docs.columns
    words = lambda df: Counter({r.source: r.n for r in df.selectExpr("source", "size(split(trim(text), '[ \\t-\\r]+')) as n").groupBy("source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()})
    before, after = words(near), words(mixed)
    assert all(after[s] <= 2 * before[s] for s in before) and sum(after.values()) > 1.2 * sum(before.values())
    packed = stages["pack"](spark, mixed, SF).collect()
    assert sum(r.start == 0 for r in packed) == mixed.count()


def test_registered_queries():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(queries.queries())
    assert corpus_pipeline.ORACLE_SQL is None


def test_exact_dedup_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    names = ["doc_id", "group_size", "keep_id", "kept", "text_sha256"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.oracle_sql()['op3_exact_dedup']}) ORDER BY 1").fetchall()
    got = queries.queries()["op3_exact_dedup"](spark, SF).select(*names).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want
