"""Sinks: parquet by day and flight, idempotent reloads, exports and archives."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CODECS = {"zstd", "snappy", "gzip", "none"}


def write_columnar(df: DataFrame, path: str, codec: str = "zstd", rows_per_file: int = 0, block_mb: int = 128, mode: str = "error") -> None:
    """Parquet with a known codec; small blocks bound memory for very wide rows."""
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}")
    df.write.mode(mode).option("compression", codec).option("maxRecordsPerFile", rows_per_file).option("parquet.block.size", block_mb << 20).parquet(path)


def cast_copy(df: DataFrame, path: str, kind: str = "double") -> None:
    """All columns cast to one type, then written."""
    df.select(*(F.col(f"`{c}`").cast(kind).alias(c) for c in df.columns)).write.option("compression", "zstd").parquet(path)


def load_days(df: DataFrame, path: str, more: Sequence[str] = ()) -> None:
    """Replace the (day, flight) partitions, split further by the columns ``more``, that ``df`` has and leave all others; loading twice equals loading once.

    Rows of a partition are sorted by time for row-group skipping. An empty frame changes nothing. Rows are
    rebalanced, not just dealt by key: Spark splits a day and flight that is too large for one task.
    """
    keyed = df.withColumn("event_date", F.to_date("time")).withColumn("flight_id", F.coalesce("flight_id", F.lit("")))
    laid = keyed.hint("rebalance", "event_date", "flight_id").sortWithinPartitions("event_date", "flight_id", *more, "time")
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("event_date", "flight_id", *more).parquet(path)


def read_days(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table of :func:`load_days`, its flights as texts even if they look like numbers, the blank one included."""
    return spark.read.schema(schema).parquet(path).withColumn("flight_id", F.coalesce("flight_id", F.lit("")))


def _committed(spark: SparkSession, path: str) -> int:
    """The newest committed version of the table at ``path``; 0 without one."""
    try:
        return spark.read.schema("version int").json(f"{path}/commits").agg(F.max("version")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def read_version(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The newest committed version of a table of :func:`replace_version`; none if there is none."""
    newest = _committed(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/version={newest}") if newest else None


def replace_version(spark: SparkSession, df: DataFrame, path: str, keep: int | None = None) -> DataFrame:
    """Write ``df``, which may be made of the table's newest version, as its next one, and commit it. One writer at a time.

    A version counts once its commit, a row of its own in ``commits``, is there: what a writer that failed halfway left is never read,
    and the next one overwrites it. Readers of an older version go on undisturbed while it is kept: all of them, or the newest
    ``keep`` (:func:`vacuum`).
    """
    number = _committed(spark, path) + 1
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/version={number}")
    spark.createDataFrame([(number,)], "version int").coalesce(1).write.mode("overwrite").json(f"{path}/commits/number={number}")
    if keep is not None:
        vacuum(path, keep)
    return spark.read.schema(df.schema).parquet(f"{path}/version={number}")


def vacuum(path: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` committed versions of a table of :func:`replace_version`; which went.

    Commits go before data, so that a version without all its files is never the one that is read. A second run ends what one that failed began.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    fs, root = FileSystem.from_uri(path if path.startswith("/") else quote(path, safe=":/@"))
    numbers = lambda folder, name: {int(f.base_name.removeprefix(name)): f.path for f in fs.get_file_info(FileSelector(folder, allow_not_found=True)) if f.type == FileType.Directory and f.base_name.startswith(name)}
    commits, data = numbers(f"{root}/commits", "number="), numbers(root, "version=")
    stay = sorted(commits)[-keep:]
    old = lambda n: bool(stay) and n < stay[0]
    for found in (commits, data):
        for n in filter(old, found):
            fs.delete_dir(found[n])
    return sorted(filter(old, data))


def ensure_table(spark: SparkSession, name: str, columns: str) -> None:
    """Create the table if it isn't there; ``columns`` as in SQL, defaults included."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def ensure_column(spark: SparkSession, table: str, name: str, kind: str, default: str) -> None:
    """Add a column that the table lacks; rows that are there get its default, an SQL literal."""
    if name not in spark.table(table).columns:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({name} {kind} DEFAULT {default})")


def add_column(df: DataFrame, name: str, kind: str, default: object) -> DataFrame:
    """``df`` with a column that older files lack; its default where it is missing or null."""
    present = F.col(name) if name in df.columns else F.lit(None).cast(kind)
    return df.withColumn(name, F.coalesce(present, F.lit(default).cast(kind)))


def query_layout(df: DataFrame, path: str) -> None:
    """By month, sorted by flight and time inside: what vehicle and week queries skip by."""
    keyed = df.withColumn("year_month", F.date_format("time", "yyyyMM"))
    keyed.hint("rebalance", "year_month").sortWithinPartitions("year_month", "flight_id", "time").write.mode("overwrite").option("compression", "zstd").partitionBy("year_month").parquet(path)


def export_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """One CSV file with header, so one task: for results that people open. ``bom`` puts the byte order mark before the first name."""
    first = df.columns[0]
    (df.withColumnRenamed(first, "﻿" + first) if bom else df).coalesce(1).write.csv(path, header=True)


def export_range_csv(df: DataFrame, folder: str, stem: str, time: str = "time") -> str:
    """:func:`export_csv` with byte order mark under a name that carries the time range; that path."""
    first, last = df.agg(F.date_format(F.min(time), "yyyyMMdd'T'HHmmss"), F.date_format(F.max(time), "yyyyMMdd'T'HHmmss")).first()
    path = f"{folder}/{stem}_{first or 'none'}_{last or 'none'}"
    export_csv(df, path, bom=True)
    return path


def export_per_flight(df: DataFrame, path: str) -> None:
    """One CSV folder per flight; rows without a flight are left out."""
    df.where(F.trim("flight_id") != "").hint("rebalance", "flight_id").write.partitionBy("flight_id").csv(path, header=True)


def split_parts(df: DataFrame, path: str, parts: int) -> None:
    """Rows dealt round robin into ``parts`` CSV files, header in each; sizes differ by one at most.

    Rows are numbered by what the tasks before hold, so ``df`` must come in the same order twice (a scan, a written table).
    """
    spot = F.monotonically_increasing_id()
    placed = df.withColumns({"_task": F.shiftright(spot, 33), "_at": spot.bitwiseAND(F.lit((1 << 33) - 1))})
    held = sorted(placed.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).collect())  # a row a task
    starts = [(task, sum(n for _, n in held[:i])) for i, (task, n) in enumerate(held)]
    table = F.broadcast(df.sparkSession.createDataFrame(starts or [(0, 0)], "_task long, _start long"))
    numbered = placed.join(table, "_task").withColumn("_part", F.pmod(F.col("_start") + F.col("_at"), F.lit(parts)).cast("int"))
    numbered.repartitionById(parts, F.col("_part")).drop("_task", "_at", "_start", "_part").write.csv(path, header=True)


def tab_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One text line a row: fields and one trailing tab. Doubles keep their shortest exact text."""
    return df.select(F.concat(F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit("\t")).alias("value"))


def write_archive(df: DataFrame, path: str, columns: Sequence[str], codec: str = "bzip2", parts: int | None = None) -> None:
    """Compressed wide files with a header line in every file."""
    write_lines(tab_text(df.repartition(parts) if parts else df, columns), path, "\t".join(columns) + "\t", codec)


def write_lines(rows: DataFrame, path: str, header: str, codec: str = "none") -> None:
    """Lines (column ``value``) as they are, under a header line in every file."""
    (rows.withColumnRenamed("value", header).write.option("compression", codec).option("header", "true").option("quote", "\u0000").option("sep", "\u0001").option("escape", "\u0000").csv(path))


def zstd_copies(spark: SparkSession, path: str, into: str, level: int = 3) -> int:
    """A ``.zst`` copy of every file behind ``path``, one task a file, streamed; the number of copies.

    Spark reads such files but writes them only where Hadoop has its native library. A copy gets its name when it is
    whole, so a task that is run again does no harm.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, source = FileSystem.from_uri(file)
                target = f"{FileSystem.from_uri(into)[1] if '://' in into or into.startswith('file:') else into}/{source.rsplit('/', 1)[1]}.zst"
                fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                part = f"{target.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
                with fs.open_input_stream(source) as src, fs.open_output_stream(part, compression=None) as dst:
                    zstandard.ZstdCompressor(level=level).copy_stream(src, dst)
                fs.move(part, target)
            yield batch

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return files.repartition(min(max(files.count(), 1), 10_000)).mapInArrow(run, "path string").count()


def write_report(df: DataFrame, path: str) -> None:
    """A one-row summary as JSON, keys sorted."""
    df.select(*sorted(df.columns)).coalesce(1).write.mode("overwrite").json(path)


def observed_write(df: DataFrame, path: str, started: float, clock, bytes_in: int | None = None) -> dict:
    """Write parquet and say how many rows, seconds, rows a second and bytes it took, and the ratio to the bytes read.

    The count comes with the write, without a second pass; sizes come from the files' metadata.
    """
    from pyspark.sql import Observation

    seen = Observation("write")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("error").option("compression", "zstd").parquet(path)
    seconds = max(clock() - started, 1e-9)
    out = file_sizes(df.sparkSession, path).where(F.col("file").endswith(".parquet")).agg(F.sum("bytes")).first()[0] or 0
    return {"rows": seen.get["rows"], "seconds": seconds, "rows_per_s": seen.get["rows"] / seconds, "bytes_in": bytes_in, "bytes_out": out, "ratio": bytes_in / out if bytes_in and out else None}


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """file and bytes of every file behind a path, from metadata alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"))
