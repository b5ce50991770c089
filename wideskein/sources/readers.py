"""Readers: wide tab files, delimited files with an unknown delimiter, parquet, alerts, and directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wideskein.functions.scalars import file_stem, tab_fields

#: The curated telemetry contract (fixed names and types).
TELEMETRY = T.StructType(
    [T.StructField("time", T.TimestampType())]
    + [T.StructField(n, T.DoubleType()) for n in ("latitude", "longitude", "altitude", "velocity_x", "velocity_y", "velocity_z", "roll", "pitch", "yaw")]
    + [T.StructField("image_name", T.StringType())]
    + [T.StructField(n, T.DoubleType()) for n in ("box_x", "box_y", "box_w", "box_h")]
    + [T.StructField("class", T.StringType()), T.StructField("flight_id", T.StringType())]
)

ALERTS = T.StructType([T.StructField(n, T.StringType()) for n in ("timestamp", "job_name", "step_name", "error", "status", "run_id", "resolved_at")])


#: Up to this many files' header widths are broadcast (about 100 bytes each).
BROADCAST_HEADERS = 500_000


def tab_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """file, line, block, row of plain or compressed wide files; the codec goes by extension. A plain or bz2 file is read in splits.

    ``block`` is where the line's split begins; ``row`` rises along the lines of a split.
    """
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def tab_headers(lines: DataFrame, timestamp: str | int | None = 0) -> DataFrame:
    """file, header, header_row, names, n_names and ts_at (place of ``timestamp`` from 1, 0 without): each file's first line, found in the split that begins the file, for all files in one job."""
    first = lines.where("block = 0").groupBy("file").agg(F.min(F.struct("row", "line")).alias("first"))
    named = first.select("file", F.col("first.line").alias("header"), F.col("first.row").alias("header_row"), tab_fields(F.col("first.line")).alias("names"))
    at = F.lit(0) if timestamp is None else F.lit(timestamp + 1) if isinstance(timestamp, int) else F.array_position("names", timestamp).cast("int")
    return named.withColumns({"n_names": F.size("names"), "ts_at": at})


def sensor_names(spark: SparkSession, path: str | Sequence[str], timestamp: str | int | None = 0) -> DataFrame:
    """file, pos, name of the values of :func:`good_rows`: joined to a profile, not carried by every row."""
    headers = tab_headers(tab_lines(spark, path), timestamp)
    rest = F.filter("names", lambda _, i: i + 1 != F.col("ts_at"))
    return headers.select("file", F.posexplode(rest).alias("pos", "name"))


def wide_rows(spark: SparkSession, path: str | Sequence[str], timestamp: str | int | None = 0) -> DataFrame:
    """file, block, row, n_names, ts_at, fields, n_fields and values of every line but the first of a file.

    ``values`` is an array of doubles, null for fields that are no numbers. One tab at the end of a line is
    stripped. Files may differ in width; a row is checked against its own file's header by :func:`bad_rows`.
    ``timestamp`` is a name, a position or none. Header widths are broadcast up to ``BROADCAST_HEADERS`` files and
    joined by a shuffle beyond.
    """
    lines = tab_lines(spark, path)
    headers = tab_headers(lines, timestamp).select("file", "header_row", "n_names", "ts_at")
    if headers.count() <= BROADCAST_HEADERS:
        headers = F.broadcast(headers)
    joined = lines.join(headers, "file").where((F.col("block") != 0) | (F.col("row") != F.col("header_row")))
    fields = joined.select("file", "block", "row", "n_names", "ts_at", tab_fields(F.col("line")).alias("fields"))
    return fields.select("*", F.size("fields").alias("n_fields"), F.transform("fields", lambda v: v.try_cast("double")).alias("values"))


def _wrong() -> Column:
    return (F.col("n_fields") != F.col("n_names")) | F.exists("values", lambda v: v.isNull())


def bad_rows(rows: DataFrame) -> DataFrame:
    """file, block, row, expected, found and sample of the rows with a wrong field count or a field that is no number; a header line inside a file is one of them."""
    return rows.where(_wrong()).select("file", "block", "row", F.col("n_names").alias("expected"), F.col("n_fields").alias("found"), F.substring(F.array_join("fields", "\t"), 1, 200).alias("sample"))


def line_numbers(spark: SparkSession, path: str | Sequence[str], rows: DataFrame) -> DataFrame:
    """``rows`` (file, block, row and more) of the files at ``path`` with ``line``, the line's number in its file from 1: lines of the splits before it, counted once a split, and its place in its own."""
    splits = tab_lines(spark, path).groupBy("file", "block").agg(F.min("row").alias("_first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "block", "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return rows.join(starts, ["file", "block"]).withColumn("line", F.col("_before") + F.col("row") - F.col("_first") + 1).drop("_first", "_before")


def bad_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """:func:`bad_rows` with their line numbers."""
    return line_numbers(spark, path, bad_rows(wide_rows(spark, path))).select("file", "line", "expected", "found", "sample")


def numbered_rows(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """file (its name without extension), line (from 1, the header's) and values of all fields of every row: what copies of wide files are compared by."""
    rows = line_numbers(spark, path, wide_rows(spark, path, None))
    return rows.select(file_stem(F.col("file")).alias("file"), "line", "values")


def strict_rows(rows: DataFrame) -> DataFrame:
    """``rows`` that passes only if no row is bad; the first bad row fails the job with its file and counts."""
    message = F.format_string("bad row in %s: %d fields, %d expected", "file", "n_fields", "n_names")
    return rows.withColumn("values", F.when(_wrong(), F.raise_error(message)).otherwise(F.col("values")))


def good_rows(rows: DataFrame) -> DataFrame:
    """file, ts, values without the timestamp column, of the rows that are whole. Names come from :func:`sensor_names`."""
    whole = rows.where(~_wrong())
    return whole.select("file", F.when(F.col("ts_at") > 0, F.get("values", F.col("ts_at") - 1)).alias("ts"), F.filter("values", lambda _, i: i + 1 != F.col("ts_at")).alias("values"))


def column_form(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One column per sensor, for files of one width below about a thousand columns."""
    return rows.select("ts", *(F.get("values", F.lit(i)).alias(n) for i, n in enumerate(names)))


def tab_csv(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """A tab file of known columns through the CSV reader, which sees one unnamed column more."""
    schema = T.StructType([*(T.StructField(n, T.DoubleType()) for n in names), T.StructField("_pad", T.StringType())])
    return spark.read.csv(path, schema=schema, sep="\t", header=True, enforceSchema=True, maxColumns=len(names) + 2).drop("_pad")


def sniff(spark: SparkSession, path: str) -> DataFrame:
    """file, header, sep: ``;`` or ``,`` of every file, whichever its first line has more of; all files in one job."""
    first = tab_lines(spark, path).where("block = 0").groupBy("file").agg(F.min_by("line", "row").alias("header"))
    n = lambda mark: F.regexp_count("header", F.lit(mark))
    return first.withColumn("sep", F.when(n(";") > n(","), ";").otherwise(","))


def delimited(spark: SparkSession, path: str) -> DataFrame:
    """CSV files as texts, each with its own delimiter, header names trimmed, flight from the file name.

    Files are scanned together by delimiter and header, one scan a kind; a column that some files lack is null there.
    The driver gets one row a file, as it does to list them.
    """
    kinds: dict[tuple[str, str], list[str]] = {}
    for r in sniff(spark, path).collect():
        kinds.setdefault((r.sep, r.header), []).append(r.file)
    found = None
    for (sep, _), files in sorted(kinds.items()):
        df = spark.read.csv(files, sep=sep, header=True, inferSchema=False)
        df = df.withColumn("_stem", file_stem(F.col("_metadata.file_name"))).toDF(*(c.strip() for c in df.columns), "_stem")
        found = df if found is None else found.unionByName(df, allowMissingColumns=True)
    if found is None:
        raise ValueError(f"no rows and no header in {path}")
    return found


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """CSV or parquet by extension; another extension is an error, and so is a missing file (Spark's own)."""
    low = path.lower()
    if low.endswith(".csv"):
        return delimited(spark, path)
    if low.endswith(".parquet"):
        return spark.read.parquet(path).withColumn("_stem", file_stem(F.col("_metadata.file_name")))
    raise ValueError(f"neither .csv nor .parquet: {path}")


def read_many(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """All files of one type in one scan, with their paths."""
    return spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").parquet(path).withColumn("source_file", F.col("_metadata.file_path"))


def first_time(df: DataFrame, column: str = "time") -> DataFrame:
    """The first row's time, by one pruned column and a limit."""
    return df.select(column).limit(1)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts newest first, times parsed; a missing or malformed file gives no rows but the fixed columns."""
    try:
        raw = spark.read.schema(ALERTS).option("multiLine", "true").option("mode", "DROPMALFORMED").json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raw = spark.createDataFrame([], ALERTS)
    times = {c: F.try_to_timestamp(c) for c in ("timestamp", "resolved_at")}
    return raw.where(F.coalesce(*ALERTS.fieldNames()).isNotNull()).withColumns(times).orderBy(F.desc_nulls_last("timestamp"))


def named_table(spark: SparkSession, table: str) -> DataFrame:
    """A table or view by name; an unknown one is an error that lists what there is."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"no table {table}; found {sorted(t.name for t in spark.catalog.listTables())}")
    return spark.table(table)


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """name, type, nullability and default (SQL text) of a table's columns; no rows for an unknown table."""
    fields = spark.table(table).schema.fields if spark.catalog.tableExists(table) else []
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("CURRENT_DEFAULT")) for f in fields], "name string, type string, nullable boolean, default string")
