"""Checksums of files of any size, by streaming them and by trees over their pieces."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Bytes held at a time.
STEP = 4 << 20
#: Tasks that pieces of files are dealt to.
MOST_TASKS = 10_000
_DIGEST = hashlib.sha256


def _files(spark: SparkSession, path: str) -> DataFrame:
    """file and bytes from metadata alone; contents aren't read. Spark's listing passes over empty files, so those have no row."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def _digests(pieces: DataFrame) -> DataFrame:
    """``pieces`` (file, at, size and more) with the SHA-256 of those bytes, read in steps; a piece that ends early fails the job."""
    schema = StructType([*pieces.schema.fields, StructField("digest", StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for file, at, size in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size")), strict=True):
                fs, name = FileSystem.from_uri(quote(file, safe=":/@"))
                digest, left = _DIGEST(), size
                with fs.open_input_file(name) as source:
                    source.seek(at)
                    while left:
                        data = source.read(min(STEP, left))
                        if not data:
                            raise OSError(f"{file} ends {left} bytes before it should")
                        digest.update(data)
                        left -= len(data)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "digest"])

    return pieces.mapInArrow(run, schema)


def _shared_out(pieces: DataFrame) -> DataFrame:
    """A task for every piece, ``MOST_TASKS`` at most: told by number, as Spark would put so few and short rows into one task."""
    return pieces.repartition(min(max(pieces.count(), 1), MOST_TASKS))


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes and the SHA-256 of all its bytes: what common tools print. One task streams a file, however large; empty files aren't listed."""
    whole = _files(spark, path).select("file", "bytes", F.lit(0).cast("long").alias("at"), F.col("bytes").alias("size"))
    return _digests(_shared_out(whole)).select("file", "bytes", F.col("digest").alias("sha256"))


def file_pieces(spark: SparkSession, path: str, piece: int = 64 << 20) -> DataFrame:
    """file, bytes, number and digest of every ``piece`` bytes of each file: tasks share a large file."""
    files = _files(spark, path)
    last = F.greatest(F.ceil(F.col("bytes") / piece) - 1, F.lit(0)).cast("long")
    pieces = files.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("number"))
    at = F.col("number") * F.lit(piece).cast("long")
    cut = pieces.select("file", "bytes", "number", at.alias("at"), F.least(F.lit(piece).cast("long"), F.col("bytes") - at).alias("size"))
    return _digests(_shared_out(cut)).drop("at", "size")


def file_trees(spark: SparkSession, path: str, piece: int = 64 << 20, fan: int = 1024) -> DataFrame:
    """file, bytes and digest: the root of a tree over the file's pieces.

    A leaf is the SHA-256 of a piece, a node that of the lowercase hex digests of up to ``fan`` children in order, level by level
    until one is left; a file of one piece has the node over it. No task holds more than ``fan`` digests of a file. Pieces of two copies,
    or of one file at two times, tell where the bytes differ (:func:`damaged`).
    """
    if fan < 2:
        raise ValueError("a node has at least two children")
    width = F.greatest(F.ceil(F.col("bytes") / piece), F.lit(1)).cast("long")
    level = _parents(file_pieces(spark, path, piece).withColumn("width", width), fan, F.lit(False))
    most = -(-(_files(spark, path).agg(F.max("bytes")).first()[0] or 0) // (piece * fan))
    while most > 1:
        level, most = _parents(level, fan, F.col("width") == 1), -(-most // fan)
    return level.select("file", "bytes", "digest")


def _parents(level: DataFrame, fan: int, rooted: Column) -> DataFrame:
    """One level up, ``width`` nodes a file; a file that is ``rooted`` stays as it is."""
    children = F.array_sort(F.collect_list(F.struct("number", "digest")))  # bounded: fan
    grown = level.groupBy("file", "bytes", "width", F.floor(F.col("number") / fan).cast("long").alias("number")).agg(children.alias("children"))
    node = F.sha2(F.array_join(F.transform("children", lambda c: c["digest"]), ""), 256)
    made = F.when(rooted, F.col("children")[0]["digest"]).otherwise(node)
    return grown.select("file", "bytes", "number", made.alias("digest"), F.ceil(F.col("width") / fan).cast("long").alias("width"))


def damaged(kept: DataFrame, now: DataFrame) -> DataFrame:
    """file and number of the pieces of :func:`file_pieces` that changed, came or went between two lists."""
    before, after = kept.select("file", "number", F.col("digest").alias("was")), now.select("file", "number", F.col("digest").alias("is"))
    return before.join(after, ["file", "number"], "full_outer").where(~F.col("was").eqNullSafe(F.col("is"))).select("file", "number", "was", "is")
