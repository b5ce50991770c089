"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Each step looks only at what the step before left: lengths of all texts are counted, the prefix is hashed where the
length is shared, and SHA-256 is taken where length and prefix hash are shared. What a step moves is a row of
counts for each key and task. No text is shuffled to find the groups, and groups are counted with map-side sums, so
a text that makes up a third of the corpus costs one row a task.

Defined cases. A null text counts as empty, and all empty texts are one group. Of equal texts the row
with the largest doc_id stays; a null doc_id is below all others. Rows repeated with the same doc_id and
text are one document: :func:`mark` gives them one decision, :func:`keep_one` returns one of them. An
empty table gives an empty result. Extra columns pass through :func:`keep_one` unchanged; names that
begin with ``_dedup_`` or ``_near_`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideskein.llm.common import cut, keep_decided, text_hash, text_or_empty

#: Leading characters that the second step hashes.
PREFIX_CHARS = 128
#: Keys of a step up to this many are broadcast to the scan of the next one (8 to 24 bytes each).
BROADCAST_KEYS = 500_000


def _length() -> Column:
    return F.octet_length(text_or_empty()).cast("long")


def _prefix(chars: int) -> Column:
    return F.xxhash64(F.substring(text_or_empty(), 1, chars))


def _sent(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _shared(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)


def shared_keys(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """_dedup_bytes, _dedup_prefix: the lengths and prefix hashes that more than one row has, found in two steps."""
    lengths = cut(_shared(docs.select(_length().alias("_dedup_bytes")), "_dedup_bytes"), "dedup-lengths")
    left = docs.select(_length().alias("_dedup_bytes"), "text").join(_sent(lengths), "_dedup_bytes", "left_semi")
    return cut(_shared(left.select("_dedup_bytes", _prefix(prefix_chars).alias("_dedup_prefix")), "_dedup_bytes", "_dedup_prefix"), "dedup-prefixes")


def duplicate_groups(docs: DataFrame, keys: DataFrame | None = None, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per text that occurs more than once: text_sha256, keep_id, group_size."""
    keys = shared_keys(docs, prefix_chars) if keys is None else keys
    keyed = docs.select("doc_id", _length().alias("_dedup_bytes"), _prefix(prefix_chars).alias("_dedup_prefix"), "text")
    hashed = keyed.join(_sent(keys), ["_dedup_bytes", "_dedup_prefix"], "left_semi").select("doc_id", F.sha2(text_or_empty(), 256).alias("text_sha256"))
    return hashed.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")


def mark(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = cut(duplicate_groups(docs, None, prefix_chars), "dedup-groups")
    rows = docs.select("doc_id", F.sha2(text_or_empty(), 256).alias("text_sha256"))
    alone = F.col("group_size").isNull()
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The rows of ``docs`` with one row of each group of equal texts, all columns as they were.

    Only texts of shared length and prefix are hashed. What is decided is a narrow row (doc_id, text hash) for each copy
    that goes, or that stays once of several rows; a row without a copy is in no join by digest.
    """
    keys = shared_keys(docs, prefix_chars)
    keyed = docs.select("doc_id", _length().alias("_dedup_bytes"), _prefix(prefix_chars).alias("_dedup_prefix"), "text")
    suspects = keyed.join(_sent(keys), ["_dedup_bytes", "_dedup_prefix"], "left_semi")
    hashed = suspects.select("doc_id", text_hash().alias("text_hash"), F.sha2(text_or_empty(), 256).alias("text_sha256"))
    rows = cut(hashed.groupBy("text_sha256", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")), "dedup-rows")
    tops = rows.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("size")).where("size > 1").drop("size")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    decided = rows.join(_sent(cut(tops, "dedup-tops")), "text_sha256").where(~kept | (F.col("n") > 1))
    decided = decided.select(F.col("doc_id").alias("_near_id"), F.col("text_hash").alias("_near_text"), kept.alias("_near_kept"))
    return keep_decided(docs, cut(decided, "dedup-decided"), BROADCAST_KEYS)
