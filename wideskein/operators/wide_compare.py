"""Cell-by-cell comparison of copies of very wide rows, known by (file, line), without moving the rows that agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Up to this many differing blocks are broadcast (about 60 bytes each); beyond, they are joined by a shuffle.
BROADCAST_BLOCKS = 500_000
_LOW = (1 << 32) - 1


def block_digests(rows: DataFrame, lines: int) -> DataFrame:
    """file, block and digest of every ``lines`` lines of a file: how many rows, and sums of two 64-bit hashes of them.

    A task sums its own rows, so that a row a block and task is shuffled, however wide the rows are. Hashes pass over
    nulls in arrays, so the places of nulls and the width are hashed besides. Line numbers count, so rows that changed places differ.
    """
    values = F.col("values")
    nulls = F.when(F.exists(values, lambda v: v.isNull()), F.transform(values, lambda v: v.isNull()))
    parts = []
    for seed in (0, 1):
        h = F.xxhash64(F.lit(seed), "line", F.coalesce(F.size(values), F.lit(-1)), values, nulls)
        parts += [F.sum(F.shiftright(h, 32)), F.sum(h.bitwiseAND(F.lit(_LOW)))]
    return rows.groupBy("file", _block(lines)).agg(F.struct(F.count(F.lit(1)), *parts).alias("digest"))


def _block(lines: int):
    return F.floor(F.col("line") / lines).cast("long").alias("block")


def differing_blocks(a: DataFrame, b: DataFrame, lines: int = 1000) -> DataFrame:
    """file and block of the blocks of lines that don't hold the same rows in both copies."""
    left = block_digests(a, lines).withColumnRenamed("digest", "in_a")
    right = block_digests(b, lines).withColumnRenamed("digest", "in_b")
    return left.join(right, ["file", "block"], "full_outer").where(~F.col("in_a").eqNullSafe(F.col("in_b"))).select("file", "block")


def compare_wide(a: DataFrame, b: DataFrame, lines: int = 1000) -> DataFrame:
    """file, line, finding, pos, a, b: a row for each cell that differs, zero tolerance, and for each line that one copy lacks.

    Both copies have file, line and values (an array of doubles); (file, line) is unique in each and not null. Findings: ``differs``;
    ``only_a`` or ``only_b`` with a null pos for a line, and with pos for a cell beyond the other's width. NaN equals NaN,
    null equals null, -0.0 equals 0.0; a row without values (null) is as one of no cells, but its block is looked at.

    Copies that agree cost a scan each and a row a block. Of others, only rows in blocks that differ are shuffled; those with
    the same hash twice over can't be told apart (chance 2^-128 a block).
    """
    found = differing_blocks(a, b, lines).persist()
    try:
        blocks = F.broadcast(found) if found.count() <= BROADCAST_BLOCKS else found
        sides = [df.select("file", "line", "values", _block(lines)).join(blocks, ["file", "block"], "left_semi").select("file", "line", F.struct("values").alias(name)) for df, name in ((a, "in_a"), (b, "in_b"))]
        return _cells(sides[0].join(sides[1], ["file", "line"], "full_outer"))
    finally:
        found.unpersist()


def _cells(both: DataFrame) -> DataFrame:
    """Findings in rows (file, line, in_a, in_b), each side a struct of values or null."""
    x, y = F.coalesce("in_a.values", F.array().cast("array<double>")), F.coalesce("in_b.values", F.array().cast("array<double>"))
    whole = F.when(F.col("in_a").isNull(), "only_b").when(F.col("in_b").isNull(), "only_a")
    rows = both.where(whole.isNotNull() | ~F.col("in_a.values").eqNullSafe(F.col("in_b.values"))).select("file", "line", whole.alias("whole"), x.alias("x"), y.alias("y"))
    width_a, width_b = F.size("x"), F.size("y")

    def cell(pair, i):
        finding = F.when(i >= width_b, "only_a").when(i >= width_a, "only_b").when(~pair["x"].eqNullSafe(pair["y"]), "differs")
        return F.struct(finding.alias("finding"), i.alias("pos"), pair["x"].alias("a"), pair["y"].alias("b"))

    pairs = F.zip_with("x", "y", lambda p, q: F.struct(p.alias("x"), q.alias("y")))
    inside = F.filter(F.transform(pairs, cell), lambda c: c["finding"].isNotNull())
    null = lambda kind: F.lit(None).cast(kind)
    line = F.array(F.struct(F.col("whole").alias("finding"), null("int").alias("pos"), null("double").alias("a"), null("double").alias("b")))
    return rows.select("file", "line", F.inline(F.when(F.col("whole").isNotNull(), line).otherwise(inside)))
