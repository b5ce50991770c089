"""The corpus pipeline: each stage reads the documents that the one before it kept.

Stages return the columns of ``documents``; the last returns the pieces of the packed sequences. Mixing returns
a document once per full repeat it is taken, and once more with the words of its extra blocks only, so a doc_id
can come up to three times after it.

Defined cases. A null or empty text is a document without words: it is clean, one of all such ones stays after exact
dedup, mixing takes nothing of it. A null source is a source of its own. Rows without doc_id are documents, told apart by
their text; repeated rows (same doc_id and text) are one document after exact dedup. Ties go to the largest doc_id in exact
dedup and to the smallest in near-dedup. Very long texts pass whole. Empty tables give an empty result, without labels
nothing is toxic. Extra columns pass to the last stage, names beginning with ``_dedup_``, ``_near_`` and ``_mix_`` are
reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wideskein.llm import exact_dedup, mixing, near_copies, packing, simhash, toxicity
from wideskein.llm.common import cut, small_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not reject; it learns from the table ``labels``."""
    small_batches(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id.

    SimHash links texts whose fingerprints differ in three bits at most, as the operator does. Texts whose lower-cased five-word
    shingles have a likeness of 0.8 or more can lie further apart; MinHash bands and whole sets link those too. Groups are
    what either kind of link connects.
    """
    small_batches(spark)
    return near_copies.keep_one(docs, more=simhash.text_links(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated or cut to their target shares."""
    small_batches(spark)
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: Learned models, seeded selection and integer programs are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
