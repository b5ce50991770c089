"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Target tokens per source come from water-filling (no source beyond ``max_repeat`` times its size). The budget
is cut into blocks of equal tokens, and Sainte-Lague gives each source its blocks, then each shard of the
source its integer quota, always to the highest quotient. In a shard the source's documents lie end to end in
seeded order; a seeded permutation of the shard's blocks says which ones are taken once more than the others.

Only one sum per source reaches the driver (sources are a list that people write weights for); quotas of a
source's shards, at most ``MAX_SHARDS``, are found in Spark. Documents are placed with bucketed running totals, so
no source, however large, is gathered in one task. A block has ``MAX_BLOCK`` words, fewer in a corpus of less than
100,000 such blocks; a source has a shard for ``ROWS_PER_SHARD`` documents of the corpus, ``MAX_SHARDS`` at most.

Defined cases. A null text has size 0 and takes 0. A null source is a source of its own and comes last. A
source with no words has target 0. Repeated rows are separate documents, laid side by side. An empty table
gives an empty result. Extra columns are ignored by :func:`mix_plan` and kept by :func:`apply_mix`, whose
reserved names begin with ``_mix_``.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideskein.llm.common import WORD, bucket_count, cut, running_total, word_count

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MAX_REPEAT = 2
SEED = 29
MAX_BLOCK = 128
MAX_SHARDS = 64
ROWS_PER_SHARD = 8192


def water_fill(sizes: Sequence[int], weights: Sequence[float], budget: float, most: float = MAX_REPEAT) -> list[float]:
    """Split ``budget`` by weight; what exceeds ``most`` times a size is shared anew until none is above."""
    target = [0.0] * len(sizes)
    free = [i for i, s in enumerate(sizes) if s > 0]
    left = min(budget, most * sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > most * sizes[i]]
        if not over:
            for i in free:
                target[i] = left * weights[i] / total
            break
        for i in over:
            target[i] = float(most * sizes[i])
            left -= target[i]
        free = [i for i in free if i not in set(over)]
    return target


def sainte_lague(claims: Sequence[float], seats: int, caps: Sequence[int]) -> list[int]:
    """Seats by highest quotient claim / (2 * seats so far + 1), none above its cap; ties go to the earlier claim.

    A divisor below the final one seats all but a few in closed form; the rest are dealt one by one.
    """
    seats = min(seats, sum(c for c, x in zip(caps, claims, strict=True) if x > 0))
    if seats <= 0:
        return [0] * len(claims)

    def at(divisor: float) -> list[int]:
        return [min(cap, max(0, math.ceil((x / divisor - 1) / 2))) if x > 0 else 0 for x, cap in zip(claims, caps, strict=True)]

    low, high = min(x for x in claims if x > 0) / (2 * seats + 3), max(claims)
    for _ in range(200):
        mid = math.sqrt(low * high)
        if sum(at(mid)) > seats:
            low = mid
        else:
            high = mid
    got = at(high)
    heap = [(-x / (2 * g + 1), i) for i, (x, g, cap) in enumerate(zip(claims, got, caps, strict=True)) if x > 0 and g < cap]
    heapq.heapify(heap)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-claims[i] / (2 * got[i] + 1), i))
    return got


def _permutation(blocks: int, key: int) -> tuple[int, int]:
    """Factor and offset of a seeded permutation of range(blocks)."""
    if blocks < 2:
        return 1, 0
    factor = (key * 2654435761 + int(blocks * 0.6180339887)) % blocks or 1
    while math.gcd(factor, blocks) != 1:
        factor = factor % blocks + 1
    return factor, (key * 40503 + 12345) % blocks


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken, and its place: _mix_start, block, blocks, base, extra, factor, offset."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", "source", word_count().alias("size"))
    rows = cut(keyed.withColumn("_mix_null", F.col("source").isNull()).withColumn("_mix_source", F.coalesce("source", F.lit(""))), "mix-rows")
    place = ["_mix_null", "_mix_source", "_mix_shard"]
    n_shards = max(1, min(MAX_SHARDS, rows.count() // ROWS_PER_SHARD))
    rows = rows.withColumn("_mix_shard", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.lit(n_shards)).cast("int"))
    sums = cut(rows.groupBy(*place).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("_mix_rows")), "mix-sums")
    found = sorted((r._mix_null, r._mix_source, r.n) for r in sums.groupBy("_mix_null", "_mix_source").agg(F.sum("n").alias("n")).collect())
    sizes = [n for *_, n in found]
    total = sum(sizes)
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], budget * total, max_repeat)
    block = max(1, min(MAX_BLOCK, total // 100_000))
    seats = sainte_lague(targets, round(sum(targets) / block), [max_repeat * -(-n // block) for n in sizes])
    planned = [(null, source, i, n, targets[i], seats[i]) for i, (null, source, n) in enumerate(found)]
    planned = spark.createDataFrame(planned, "_mix_null boolean, _mix_source string, _mix_rank long, source_size long, target double, _mix_seats long")

    def quotas(shards: pd.DataFrame) -> pd.DataFrame:
        """The at most ``MAX_SHARDS`` shards of a source with their blocks to take."""
        shards = shards.sort_values("_mix_shard")
        blocks = [-(-n // block) for n in shards["n"].tolist()]
        got = sainte_lague([float(n) for n in shards["n"]], int(shards["_mix_seats"].iloc[0]), [max_repeat * b for b in blocks])
        key = 31 * int(shards["_mix_rank"].iloc[0]) + seed
        turned = [_permutation(b, key + 1009 * shard) for b, shard in zip(blocks, shards["_mix_shard"].tolist(), strict=True)]
        return shards[[*place, "_mix_rows", "source_size", "target"]].assign(
            _mix_blocks=blocks, _mix_base=[q // b if b else 0 for q, b in zip(got, blocks, strict=True)], _mix_extra=[q % b if b else 0 for q, b in zip(got, blocks, strict=True)], _mix_factor=[f for f, _ in turned], _mix_offset=[o for _, o in turned]
        )

    schema = "_mix_null boolean, _mix_source string, _mix_shard int, _mix_rows long, source_size long, target double, _mix_blocks long, _mix_base long, _mix_extra long, _mix_factor long, _mix_offset long"
    table = cut(sums.join(planned, ["_mix_null", "_mix_source"]).groupBy("_mix_null", "_mix_source").applyInPandas(quotas, schema), "mix-quotas")
    if len(found) * n_shards <= 100_000:
        table = F.broadcast(table)
    placed = running_total(rows.join(table, place), place, ["doc_id", "size"], "size", "_mix_start", bucket_count(F.col("_mix_rows"))).withColumn("_mix_block", F.lit(block).cast("long"))
    extra = F.expr(
        """CASE WHEN size = 0 OR _mix_extra = 0 THEN 0L ELSE aggregate(
             sequence(_mix_start div _mix_block, (_mix_start + size - 1) div _mix_block), 0L,
             (acc, b) -> acc + IF(pmod(b * _mix_factor + _mix_offset, _mix_blocks) < _mix_extra,
                 least(_mix_start + size, (b + 1) * _mix_block) - greatest(_mix_start, b * _mix_block), 0L)) END"""
    )
    return placed.withColumn("taken", (F.col("_mix_base") * F.col("size") + extra).cast("long"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: whole texts once per full repeat, and the words of the extra blocks as a shorter text.

    Repeated rows (same doc_id, source and size) share the plan of one of them. Documents that the mix takes nothing of are left out.
    """
    plan = mix_plan(docs, **options)
    names = ["_mix_start", "_mix_block", "_mix_blocks", "_mix_base", "_mix_extra", "_mix_factor", "_mix_offset"]
    once = plan.where("taken > 0").groupBy("doc_id", "source", "size").agg(*(F.first(n).alias(n) for n in names))
    once = cut(once.withColumnsRenamed({"doc_id": "_mix_id", "source": "_mix_src", "size": "_mix_size"}), "mix-plan")
    joined = docs.withColumn("_mix_words", word_count()).join(
        once, F.col("doc_id").eqNullSafe(F.col("_mix_id")) & F.col("source").eqNullSafe(F.col("_mix_src")) & (F.col("_mix_words") == F.col("_mix_size"))
    )
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    joined = joined.withColumn("_mix_list", F.when(F.col("_mix_extra") > 0, words).otherwise(F.array().cast("array<string>")))
    picked = F.expr("filter(_mix_list, (w, i) -> pmod(((_mix_start + i) div _mix_block) * _mix_factor + _mix_offset, _mix_blocks) < _mix_extra)")
    part = F.when(F.size(picked) > 0, F.array(F.array_join(picked, " "))).otherwise(F.array().cast("array<string>"))
    whole = F.expr("array_repeat(text, cast(_mix_base as int))")
    copies = joined.withColumn("_mix_texts", F.concat(whole, part)).select("*", F.posexplode("_mix_texts").alias("_mix_copy", "_mix_text"))
    is_part = F.col("_mix_copy") >= F.col("_mix_base")
    changed = {"text": F.col("_mix_text")} if "n_chars" not in docs.columns else {"text": F.col("_mix_text"), "n_chars": F.when(is_part, F.length("_mix_text").cast("long")).otherwise(F.col("n_chars"))}
    return copies.select(*(changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns))
