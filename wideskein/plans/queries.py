"""Registered queries of the library's own operators, each with its SQL."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wideskein.functions import filters, scalars, variants
from wideskein.operators import browse, cleaning, history, profiling, quality, reconciling, wide_compare, wide_profile
from wideskein.plans.telemetry import dirty, table, telemetry
from wideskein.sources import checksums, readers, sinks
from wideskein.streaming import alerts, arrivals, progress

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

#: ``telemetry`` and ``dirty`` in SQL.
TEL = "(SELECT event_id, ts AS time, CAST(user_id AS VARCHAR) AS flight_id, event_type AS class, value AS altitude FROM events)"
DIRTY = f"""(WITH rows AS (SELECT CASE WHEN event_id % 11 = 0 THEN 'not a time' ELSE strftime(time, '%Y-%m-%d %H:%M:%S') END AS time,
 CASE WHEN event_id % 7 = 0 THEN 'x' WHEN event_id % 13 = 0 THEN 'NaN' ELSE CAST(altitude AS VARCHAR) END AS altitude, class, flight_id, event_id FROM {TEL} t)
 SELECT * FROM rows UNION ALL SELECT * FROM rows WHERE event_id % 5 = 0)"""

START, END = datetime(2024, 1, 5), datetime(2024, 1, 20, 12)


def query(sql: str | None = None):
    def add(f):
        REGISTRY[f.__name__] = (f, sql)
        return f

    return add


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, under spark.checkpoint.dir; only local mode may leave that unset and use the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/wideskein/{name}-{uuid.uuid4().hex}"


# Browse and filters.


@query(f"""SELECT DISTINCT time, flight_id, class, altitude FROM {TEL} t WHERE time >= TIMESTAMP '2024-01-05' AND time <= TIMESTAMP '2024-01-20 12:00:00'
 AND class IN ('click', 'error') AND altitude BETWEEN 10 AND 50 ORDER BY time""")
def browse_filtered(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    condition = filters.telemetry_filter(t, START, END, ["click", "error"], None, [{"column": "altitude", "op": "between", "low": 50, "high": 10}, {"column": "nope", "op": "<", "value": 1}])
    return browse.distinct_rows(t, condition, ["time", "flight_id", "class", "altitude", "missing"])


@query(f"SELECT event_id, time, flight_id FROM {TEL} t WHERE flight_id IN ('8', '46', '101') AND altitude >= 5 AND class <> 'view' AND time <= TIMESTAMP '2024-01-20 12:00:00'")
def flight_filtered(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    return t.where(filters.telemetry_filter(t, None, END, [], ["8", "46", "101"], [{"column": "altitude", "op": ">=", "value": 5}, {"column": "class", "op": "!=", "value": "view"}])).select("event_id", "time", "flight_id")


@query(f"SELECT event_id, time FROM {TEL} t WHERE time >= TIMESTAMP '2024-01-07' AND time < TIMESTAMP '2024-01-08'")
def day_partition(spark, sf_dir):
    return telemetry(spark, sf_dir).where(filters.on_day(F.col("time"), "2024-01-07")).select("event_id", "time")


@query(f"SELECT count(*) AS n_rows FROM (SELECT DISTINCT * FROM {TEL} t WHERE class = 'view')")
def count_distinct_rows(spark, sf_dir):
    return browse.count_distinct_rows(telemetry(spark, sf_dir), F.col("class") == "view")


@query(f"SELECT DISTINCT class FROM {TEL} t ORDER BY 1")
def distinct_classes(spark, sf_dir):
    return browse.choices(telemetry(spark, sf_dir), "class")


@query(f"SELECT DISTINCT flight_id FROM {TEL} t WHERE trim(flight_id) <> '' ORDER BY 1")
def distinct_flights(spark, sf_dir):
    return browse.choices(telemetry(spark, sf_dir), "flight_id", blank=False)


@query(f"SELECT min(time) AS first, max(time) AS last FROM {TEL} t")
def time_bounds(spark, sf_dir):
    return browse.bounds(telemetry(spark, sf_dir))


@query(f"SELECT flight_id, count(*) AS n_rows FROM {TEL} t GROUP BY 1")
def rows_per_flight(spark, sf_dir):
    return browse.rows_per(telemetry(spark, sf_dir), "flight_id")


@query(f"SELECT event_id, altitude FROM {TEL} t WHERE altitude BETWEEN least(80, 20) AND greatest(80, 20)")
def between_swapped(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    return t.where(filters.all_of(filters.value_filters(t, [{"column": "altitude", "op": "between", "low": 80, "high": 20}]))).select("event_id", "altitude")


@query(f"SELECT class, flight_id FROM (SELECT class, flight_id, min(time) AS f FROM {TEL} t GROUP BY 1, 2) ORDER BY f")
def distinct_order_by_hidden(spark, sf_dir):
    return browse.distinct_rows(telemetry(spark, sf_dir), F.lit(True), ["class", "flight_id"])


@query(f"SELECT class, altitude, flight_id FROM (SELECT class, altitude, flight_id, min(time) AS f FROM {TEL} t WHERE class = 'error' GROUP BY 1, 2, 3) ORDER BY f")
def export_projection(spark, sf_dir):
    return browse.distinct_rows(telemetry(spark, sf_dir), F.col("class") == "error", ["class", "altitude"], always=["flight_id"])


@query("SELECT url, page_id FROM pages WHERE coalesce(regexp_matches(url, '(?i)/EN/'), false)")
def search_contains(spark, sf_dir):
    return table(spark, sf_dir, "pages").where(filters.contains(F.col("url"), "/EN/")).select("url", "page_id")


@query(f"""SELECT 'hour' AS span, count(*) AS n_rows FROM {TEL} t WHERE time >= TIMESTAMP '2024-01-15 11:00:00' AND time <= TIMESTAMP '2024-01-15 12:00:00'
 UNION ALL SELECT 'day', count(*) FROM {TEL} t WHERE CAST(time AS DATE) = DATE '2024-01-15' UNION ALL SELECT 'all', count(*) FROM {TEL} t""")
def recency_windows(spark, sf_dir):
    now = F.lit(datetime(2024, 1, 15, 12))
    flags = [F.count_if(filters.recent(F.col("time"), w, now)).alias(w) for w in ("hour", "day", "all")]
    return telemetry(spark, sf_dir).agg(*flags).select(F.inline(F.array(*(F.struct(F.lit(w).alias("span"), F.col(w).alias("n_rows")) for w in ("hour", "day", "all")))))


@query(f"SELECT event_id, time FROM {TEL} t ORDER BY time DESC, event_id LIMIT 500")
def top_recent(spark, sf_dir):
    return browse.newest(telemetry(spark, sf_dir), "time", ["event_id"], 500).select("event_id", "time")


@query("SELECT event_id, altitude FROM (SELECT event_id, value AS altitude FROM events ORDER BY event_id DESC LIMIT 10)")
def two_columns_ten_rows(spark, sf_dir):
    """A look at two columns: the ten rows with the highest ids, so that it is the same ten each time."""
    return browse.preview(telemetry(spark, sf_dir).select("event_id", "altitude").orderBy(F.desc("event_id")), 10)


@query("SELECT l_returnflag, l_linestatus FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem) LIMIT 200")
def preview_rows(spark, sf_dir):
    return browse.preview(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct(), 200)


@query("""SELECT count(l_quantity) AS l_quantity_count, round(avg(l_quantity), 6) AS l_quantity_avg, min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max,
 CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity_sum FROM lineitem""")
def numeric_summary(spark, sf_dir):
    made = browse.numeric_summary(table(spark, sf_dir, "lineitem"), ["l_quantity"])
    return made.withColumns({"l_quantity_avg": F.round("l_quantity_avg", 6), "l_quantity_sum": F.round("l_quantity_sum", 2)})


@query("SELECT count(*) FILTER (WHERE l_discount = 0) AS n_true, round(avg(CASE WHEN l_discount = 0 THEN 1.0 ELSE 0.0 END), 9) AS share FROM lineitem")
def flag_share(spark, sf_dir):
    return browse.flag_share(table(spark, sf_dir, "lineitem"), F.col("l_discount") == 0).withColumn("share", F.round("share", 9))


@query("SELECT class FROM (VALUES ('click'), ('gone'), ('view')) v(class) WHERE class IN (SELECT event_type FROM events)")
def only_existing(spark, sf_dir):
    selected = spark.createDataFrame([("click",), ("gone",), ("view",)], "class string")
    return browse.only_existing(selected, telemetry(spark, sf_dir), "class")


# Cleaning.


@query(f"""SELECT DISTINCT try_cast(time AS TIMESTAMP) AS time, CASE WHEN isnan(try_cast(altitude AS DOUBLE)) THEN NULL ELSE try_cast(altitude AS DOUBLE) END AS altitude,
 class, flight_id, event_id FROM {DIRTY} d WHERE try_cast(time AS TIMESTAMP) IS NOT NULL""")
def clean_coerce(spark, sf_dir):
    return cleaning.processed(dirty(spark, sf_dir), ["altitude"], ["time"])


@query(f"""SELECT event_id, altitude FROM (SELECT event_id, CASE WHEN isnan(try_cast(altitude AS DOUBLE)) THEN NULL ELSE try_cast(altitude AS DOUBLE) END AS altitude FROM {DIRTY} d)
 WHERE altitude > 100""")
def nan_to_null_filter(spark, sf_dir):
    rows = cleaning.nans_to_nulls(cleaning.coerce(dirty(spark, sf_dir), ["altitude"]))
    return rows.where("altitude > 100").select("event_id", "altitude")


@query(f"SELECT count(*) FILTER (WHERE isnan(try_cast(altitude AS DOUBLE))) AS altitude FROM {DIRTY} d")
def nan_counts(spark, sf_dir):
    return cleaning.nan_counts(cleaning.coerce(dirty(spark, sf_dir), ["altitude"]).select("altitude"))


@query("SELECT CAST(s_suppkey AS DOUBLE) AS s_suppkey, CAST(s_nationkey AS DOUBLE) AS s_nationkey, s_acctbal FROM supplier")
def cast_all(spark, sf_dir):
    return cleaning.cast_all(table(spark, sf_dir, "supplier").drop("s_name"))


@query("""SELECT event_id, to_timestamp(CAST(event_id * 86400 + 1700000000 AS DOUBLE))::TIMESTAMP AS as_seconds, make_timestamp((event_id + 1700000000000) * 1000) AS as_millis FROM events""")
def epoch_convert(spark, sf_dir):
    """Days as seconds, which pass 1e10 from event 96,065 on, so their unit is told; milliseconds are known by their size."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", scalars.epoch_to_time((F.col("event_id") * 86400 + 1700000000).cast("double"), "s").alias("as_seconds"), scalars.epoch_to_time((F.col("event_id") + 1700000000000).cast("double")).alias("as_millis"))


@query("""SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN CAST(ts AS DATE) WHEN event_id % 3 = 1 THEN CAST(ts AS DATE) + 1 ELSE DATE '2026-02-03' END AS VARCHAR) AS day,
 CASE WHEN event_id % 3 = 0 THEN 'telemetry_' || strftime(ts, '%Y-%m-%d') ELSE 'flight.' || CAST(user_id AS VARCHAR) END AS stem FROM events""")
def date_from_name(spark, sf_dir):
    e, n = table(spark, sf_dir, "events"), F.col("event_id")
    name = F.when(n % 3 == 0, F.concat(F.lit("/in/telemetry_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv"))).otherwise(F.concat(F.lit("/in/flight."), F.col("user_id").cast("string"), F.lit(".csv")))
    peek = F.when(n % 3 == 1, F.col("ts") + F.expr("INTERVAL 1 DAY"))
    return e.select("event_id", scalars.partition_date(name, peek, F.lit("2026-02-03 04:05:06").cast("timestamp")).cast("string").alias("day"), scalars.file_stem(name).alias("stem"))


@query("SELECT event_id, CAST(strftime(ts, '%Y%m') AS INTEGER) AS month, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def month_and_day_keys(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", scalars.month_key(F.col("ts")).alias("month"), F.to_date("ts").cast("string").alias("day"))


@query("SELECT event_id, 'k' AS field, json_extract_string(props, '$.k') AS value FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def metadata_explode(spark, sf_dir):
    return history.metadata_fields(table(spark, sf_dir, "events").where("get_json_object(props, '$.k') is not null"), "event_id", "props")


@query("""WITH e AS (SELECT event_id, event_type, user_id, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
 SELECT event_id, 'rows' AS field, 'int' AS kind, user_id AS int_value, NULL::DOUBLE AS float_value, NULL::BOOLEAN AS bool_value, NULL AS text, NULL AS json FROM e
 UNION ALL SELECT event_id, 'value', CASE WHEN value IS NULL THEN 'null' ELSE 'float' END, NULL, value, NULL, NULL, NULL FROM e
 UNION ALL SELECT event_id, 'even', 'bool', NULL, NULL, event_id % 2 = 0, NULL, NULL FROM e
 UNION ALL SELECT event_id, 'class', CASE WHEN event_type IS NULL THEN 'null' ELSE 'text' END, NULL, NULL, NULL, event_type, NULL FROM e
 UNION ALL SELECT event_id, 'props', CASE WHEN k IS NULL THEN 'null' ELSE 'json' END, NULL, NULL, NULL, NULL, '{"k":' || CAST(k AS VARCHAR) || '}' FROM e""")
def metadata_typed(spark, sf_dir):
    """Metadata entries of every event as VARIANT objects, written, read and taken apart with the types they had."""
    path, e = scratch(spark, "variants"), table(spark, sf_dir, "events")
    kinds = {"text": "string", "int_value": "bigint", "float_value": "double", "bool_value": "boolean", "json": "string"}
    entry = lambda label, name, value: F.struct(F.lit(label).alias("label"), *((value if n == name else F.lit(None)).cast(t).alias(n) for n, t in kinds.items()))
    base = variants.entries_to_variants(F.array(entry("rows", "int_value", F.col("user_id")), entry("value", "float_value", F.col("value")), entry("class", "text", F.lit("hidden")), entry("class", "text", F.col("event_type"))))
    more = variants.entries_to_variants(F.array(entry("even", "bool_value", F.col("event_id") % 2 == 0), entry("rows", "text", F.lit("hidden")), entry("props", "json", F.col("props"))))
    sinks.write_columnar(e.select("event_id", variants.overlay(base, more).alias("metadata")), path)
    return variants.typed_fields(spark.read.parquet(path), "event_id", "metadata")


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"k":' || json_extract_string(props, '$.k') || '}' ELSE 'raw ' || CAST(event_id AS VARCHAR) END AS meta,
 'base' AS k, event_type AS extra FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def metadata_overlay(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("get_json_object(props, '$.k') is not null")
    text = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit("raw "), F.col("event_id").cast("string")))
    entry = lambda label, text: F.struct(F.lit(label).alias("label"), text.alias("text"), F.lit(None).cast("long").alias("int_value"), F.lit(None).cast("double").alias("float_value"), F.lit(None).cast("boolean").alias("bool_value"))
    more = scalars.entries_to_map(F.array(entry("k", F.lit("hidden")), entry("extra", F.col("event_type"))))
    both = scalars.overlay(F.create_map(F.lit("k"), F.lit("base")), more)
    return e.select("event_id", scalars.json_or_text(text).alias("meta"), both["k"].alias("k"), both["extra"].alias("extra"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice BETWEEN 0 AND 255 AND l_extendedprice = floor(l_extendedprice) THEN l_extendedprice END AS price_byte, CASE WHEN l_quantity BETWEEN 0 AND 255 AND l_quantity = floor(l_quantity) THEN CAST(l_quantity AS SMALLINT) END AS l_quantity FROM lineitem")
def safe_narrow(spark, sf_dir):
    rows = profiling.narrowed(table(spark, sf_dir, "lineitem"), "l_quantity")
    return rows.select("l_orderkey", "l_linenumber", scalars.byte_or_null(F.col("l_extendedprice")).cast("double").alias("price_byte"), "l_quantity")


@query("""SELECT count(*) FILTER (WHERE NOT (l_extendedprice BETWEEN 0 AND 255 AND l_extendedprice = floor(l_extendedprice))) AS l_extendedprice,
 count(*) FILTER (WHERE NOT (l_tax BETWEEN 0 AND 255 AND l_tax = floor(l_tax))) AS l_tax FROM lineitem""")
def out_of_byte_range(spark, sf_dir):
    return profiling.out_of_range(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_tax"])


# Profiles and fingerprints.

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _sql_profile(extra: str = "") -> str:
    one = "SELECT '{c}' AS name, count({c}) AS n, CAST(sum(CAST({c} AS DECIMAL(28,6))) AS DECIMAL(38,6)) AS total, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high, bool_and({c} = floor({c})) AS integral, count(*) FILTER (WHERE {c} NOT IN (0, 1)) AS n_not_flag FROM lineitem"
    return " UNION ALL ".join(one.format(c=c) for c in NUMBERS)


@query(f"SELECT name, n, CAST(total AS DOUBLE) AS total, low, high FROM ({_sql_profile()})")
def column_profile(spark, sf_dir):
    made = profiling.profile_narrow(table(spark, sf_dir, "lineitem"), NUMBERS)
    return made.select("name", "n", F.col("total").cast("double").alias("total"), "low", "high")


@query(f"""SELECT name, CASE WHEN low = 0 AND high = 0 THEN 'constant_zero' WHEN low = 1 AND high = 1 THEN 'constant_one' WHEN n_not_flag = 0 THEN 'mixed_binary'
 WHEN integral AND low >= 0 AND high <= 255 THEN 'byte_safe' ELSE 'float64' END AS class FROM ({_sql_profile()})""")
def column_classes(spark, sf_dir):
    return profiling.classes(profiling.profile_narrow(table(spark, sf_dir, "lineitem"), NUMBERS)).select("name", "class")


@query(f"SELECT name, n_not_flag FROM ({_sql_profile()})")
def flag_range(spark, sf_dir):
    """Values that are neither 0 nor 1, counted before a column is narrowed to flags."""
    return profiling.not_flags(table(spark, sf_dir, "lineitem"), NUMBERS)


@query("""SELECT *, substr(content_fingerprint, 1, 16) AS short FROM (SELECT count(*) AS row_count, sha256('{"col_sum":[' || CAST(CAST(round(sum(CAST(l_quantity AS DECIMAL(28,6))), 4) AS DECIMAL(38,4)) AS VARCHAR) || ',' ||
 CAST(CAST(round(sum(CAST(l_extendedprice AS DECIMAL(28,6))), 4) AS DECIMAL(38,4)) AS VARCHAR) || ',' || CAST(CAST(round(sum(CAST(l_discount AS DECIMAL(28,6))), 4) AS DECIMAL(38,4)) AS VARCHAR)
 || '],"row_count":' || CAST(count(*) AS VARCHAR) || '}') AS content_fingerprint FROM lineitem)""")
def content_fingerprint(spark, sf_dir):
    made = profiling.fingerprint(profiling.profile_narrow(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))
    return made.withColumn("short", profiling.short(F.col("content_fingerprint")))


@query("""SELECT CAST(pos AS INTEGER) AS pos, count(*) AS n, CAST(sum(v) AS DOUBLE) AS total, min(v) AS low, max(v) AS high FROM (
 SELECT (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) - 1) % 1000 AS pos, (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) - 1) // 1000 AS line, CAST(CAST(l_quantity AS DECIMAL(28,6)) AS DECIMAL(28,6)) AS v FROM lineitem)
 WHERE line < (SELECT count(*) // 1000 FROM lineitem) GROUP BY pos""")
def wide_file_profile(spark, sf_dir):
    """The central workload: wide tab files of 1,001 columns (made of ``lineitem``, 1,000 values a row) are written, scanned, checked and profiled, names joined last.

    Rows are numbered within a thousandth of the order keys, by counts of what comes before; rests of less than a row are left out.
    """
    path = scratch(spark, "wide")
    cells = _numbered_cells(table(spark, sf_dir, "lineitem"))
    rows = cells.groupBy((F.col("at").cast("long") / 1000).cast("long").alias("line")).agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("cells")).where("size(cells) = 1000")  # bounded: 1,000 cells a row
    text = rows.select(F.concat_ws("\t", F.col("line").cast("string"), F.concat_ws("\t", F.transform("cells", lambda c: c["v"].cast("string"))), F.lit("")).alias("value"))
    header = "\t".join(["timestamp", *(f"f{i}" for i in range(1000))]) + "\t"
    sinks.write_lines(text, path, header)
    good = readers.good_rows(readers.wide_rows(spark, path))
    made = wide_profile.profile_wide(good)
    named = made.join(readers.sensor_names(spark, path).select("pos", "name").distinct(), "pos").where("name = concat('f', pos)")
    return named.select("pos", "n", F.col("total").cast("double").alias("total"), F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"))


@query("""SELECT 'sevenths' AS name, count(*) AS n, count(*) * CAST('1e-7' AS DOUBLE) AS total FROM lineitem UNION ALL SELECT 'large', count(*), count(*) * CAST('1e23' AS DOUBLE) FROM lineitem
 UNION ALL SELECT 'tiny', count(*), sum(CAST(l_quantity AS BIGINT))::DOUBLE * pow(2.0::DOUBLE, -60) FROM lineitem UNION ALL SELECT 'huge', count(*), sum(CAST(l_quantity AS BIGINT))::DOUBLE * pow(2.0::DOUBLE, 300) FROM lineitem
 UNION ALL SELECT 'both', 3 * count(*), sum(CAST(l_quantity AS BIGINT))::DOUBLE * pow(2.0::DOUBLE, -60) FROM lineitem""")
def sums_of_any_magnitude(spark, sf_dir):
    """Sums of doubles far below and far above what decimals hold; in the column ``both`` the large values cancel and leave the small ones' sum."""
    q = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("double").alias("q"))
    rows = q.select(F.lit(1e-7).alias("sevenths"), F.lit(1e23).alias("large"), (F.col("q") * 2.0**-60).alias("tiny"), (F.col("q") * 2.0**300).alias("huge"))
    all_three = rows.select("*", F.explode(F.array("huge", "tiny", -F.col("huge"))).alias("both"))
    made = profiling.profile_narrow(rows, rows.columns).unionByName(profiling.profile_narrow(all_three, ["both"]))
    return made.select("name", "n", "total")


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _numbered_cells(lineitem: DataFrame) -> DataFrame:
    """at, v: quantities numbered from 0 in order of all their keys, bucket by bucket of order keys."""
    cells = lineitem.select(*LINE_KEYS, F.col("l_quantity").alias("v"), (F.col("l_orderkey") / 1000).cast("long").alias("bucket"))
    counts = cells.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("bucket").orderBy(*LINE_KEYS, "v")
    return cells.withColumn("nth", F.row_number().over(inside) - 1).join(starts, "bucket").select((F.col("start") + F.col("nth")).alias("at"), "v")


@query("""SELECT CAST(pos AS INTEGER) AS pos, count(*) AS n, CAST(round(CAST(min(v) AS DOUBLE), 6) AS DOUBLE) AS low, CAST(round(CAST(max(v) AS DOUBLE), 6) AS DOUBLE) AS high FROM
 (SELECT unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY 1""")
def array_profile(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.lit("embeddings").alias("file"), F.col("embedding").cast("array<double>").alias("values"))
    made = profiling.profile(profiling.wide_form(rows), ["file", "pos"])
    return made.select("pos", "n", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


# Reconciliation.


@query("""SELECT key, n_tab, n_parquet, n_store FROM (SELECT o_custkey AS key, count(*) AS n_tab FROM orders GROUP BY 1)
 FULL JOIN (SELECT o_custkey AS key, count(*) AS n_parquet FROM orders WHERE o_orderkey % 50 <> 0 GROUP BY 1) USING (key)
 FULL JOIN (SELECT c_custkey AS key, count(*) AS n_store FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1) USING (key)
 WHERE n_tab IS DISTINCT FROM n_parquet OR n_tab IS DISTINCT FROM n_store""")
def reconcile_layers(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    store = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    layers = [reconciling.counts(orders, "o_custkey", "n_tab"), reconciling.counts(orders.where("o_orderkey % 50 <> 0"), "o_custkey", "n_parquet"), reconciling.counts(store, "o_custkey", "n_store")]
    return reconciling.reconcile(layers, ["n_tab", "n_parquet", "n_store"])


@query("""SELECT name, n AS rows_a, n AS rows_b, sum_a, sum_b, d AS max_abs_diff, d <= 1e-8 AS close FROM (
 SELECT 'o_totalprice' AS name, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS sum_a, CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS sum_b, 0.0::DOUBLE AS d FROM orders
 UNION ALL SELECT 'o_custkey', count(*), CAST(sum(CAST(o_custkey AS DECIMAL(28,6))) AS DOUBLE), CAST(sum(CAST(CASE WHEN o_orderkey % 70 = 0 THEN o_custkey + 3 ELSE o_custkey END AS DECIMAL(28,6))) AS DOUBLE), 3.0 FROM orders)""")
def compare_copies(spark, sf_dir):
    a = table(spark, sf_dir, "orders")
    b = a.withColumn("o_custkey", F.when(F.col("o_orderkey") % 70 == 0, F.col("o_custkey") + 3).otherwise(F.col("o_custkey")))
    return reconciling.compare_copies(a, b, ["o_orderkey"], ["o_totalprice", "o_custkey"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'only_a' WHEN o_orderkey % 77 = 0 THEN 'differs' END AS finding,
 CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE 'o_totalprice' END AS columns FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 77 = 0""")
def compare_cells(spark, sf_dir):
    a = table(spark, sf_dir, "orders")
    b = a.where("o_orderkey % 101 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 77 == 0, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")))
    found = reconciling.compare_cells(a, b, ["o_orderkey"], ["o_totalprice", "o_orderstatus"])
    return found.withColumn("columns", F.when(F.col("finding") == "only_a", "").otherwise(F.col("columns")))


WIDE_A = "SELECT o_orderstatus AS file, o_orderkey AS line, CAST(o_custkey AS DOUBLE) AS c0, o_totalprice AS c1, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(year(o_orderdate) AS DOUBLE) END AS c2 FROM orders"


@query(f"""WITH a AS ({WIDE_A}), cells AS (SELECT file, line, unnest([0, 1, 2]) AS pos, unnest([c0, c1, c2]) AS a FROM a),
 changed AS (SELECT file, line, pos, a, CASE WHEN pos = 1 THEN a + 1 WHEN a IS NULL THEN CAST(0 AS DOUBLE) END AS b FROM cells WHERE line BETWEEN 2000 AND 2100 AND pos > 0)
 SELECT file, line, 'differs' AS finding, CAST(pos AS INTEGER) AS pos, a, b FROM changed WHERE a IS DISTINCT FROM b
 UNION ALL SELECT file, line, 'only_a', NULL, NULL, NULL FROM a WHERE line BETWEEN 2501 AND 2520 UNION ALL SELECT file, -line - 1, 'only_b', NULL, NULL, NULL FROM a WHERE line <= 9
 UNION ALL SELECT file, line, 'only_b', 3, NULL, CAST(7 AS DOUBLE) FROM a WHERE line BETWEEN 900 AND 905""")
def compare_wide_copies(spark, sf_dir):
    """Rows of values by (file, line) against a copy with changed, lost and added cells and lines in a few blocks; a hot file holds about half of all rows."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("file"), F.col("o_orderkey").alias("line"), F.col("o_custkey").cast("double").alias("c0"), F.col("o_totalprice").alias("c1"), F.when(F.col("o_orderkey") % 3 != 0, F.year("o_orderdate").cast("double")).alias("c2"))
    a, line = o.select("file", "line", F.array("c0", "c1", "c2").alias("values")), F.col("line")
    changed = F.when(line.between(2000, 2100), F.array("c0", F.col("c1") + 1, F.when(F.col("c2").isNull(), 0.0))).when(line.between(900, 905), F.array("c0", "c1", "c2", F.lit(7.0))).otherwise(F.array("c0", "c1", "c2"))
    b = o.select("file", "line", changed.alias("values")).where(~line.between(2501, 2520))
    return wide_compare.compare_wide(a, b.unionByName(a.where(line <= 9).withColumn("line", -line - 1)), 100)


@query("""SELECT o_orderkey, o_orderstatus, 'a' AS side FROM orders WHERE o_orderkey % 90 = 0
 UNION ALL SELECT o_orderkey, 'X', 'b' FROM orders WHERE o_orderkey % 90 = 0""")
def copy_difference(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return reconciling.difference(a, a.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 90 == 0, "X").otherwise(F.col("o_orderstatus"))))


@query("""WITH t AS (SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'n/a' ELSE CAST(s_acctbal AS VARCHAR) END AS s_acctbal, CAST(s_nationkey AS VARCHAR) || '.5' AS s_nationkey, s_name FROM supplier),
 cells AS (UNPIVOT t ON COLUMNS(*) INTO NAME name VALUE v),
 found AS (SELECT name, CASE WHEN count(v) = count(TRY_CAST(v AS BIGINT)) FILTER (WHERE v NOT LIKE '%.%') THEN 'bigint' WHEN count(v) = count(TRY_CAST(v AS DOUBLE)) THEN 'double' ELSE 'string' END AS found FROM cells GROUP BY 1),
 expected AS (SELECT * FROM (VALUES ('s_suppkey', 'bigint'), ('s_acctbal', 'double'), ('s_nationkey', 'bigint'), ('s_phone', 'string')) v(name, expected))
 SELECT name, expected, found, CASE WHEN found IS NULL THEN 'missing' WHEN expected IS NULL THEN 'extra' ELSE 'type' END AS finding FROM expected FULL JOIN found USING (name) WHERE expected IS DISTINCT FROM found""")
def schema_diff(spark, sf_dir):
    """What the rows of a file of texts hold, against what the table to be loaded expects."""
    supplier = table(spark, sf_dir, "supplier")
    balance = F.when(F.col("s_suppkey") % 5 == 0, "n/a").otherwise(F.col("s_acctbal").cast("string"))
    texts = supplier.select(F.col("s_suppkey").cast("string").alias("s_suppkey"), balance.alias("s_acctbal"), F.concat("s_nationkey", F.lit(".5")).alias("s_nationkey"), "s_name")
    expected = spark.createDataFrame([("s_suppkey", "bigint"), ("s_acctbal", "double"), ("s_nationkey", "bigint"), ("s_phone", "string")], "name string, type string")
    return reconciling.schema_difference(expected, reconciling.observed_types(texts))


@query("SELECT DISTINCT source AS file FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE doc_id < 10 AND source IS NOT NULL) ")
def new_files_anti(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("file"), "doc_id")
    return reconciling.unseen(d.select("file").distinct(), d.where("doc_id < 10").select("file"), "file")


@query("SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'")
def valid_days(spark, sf_dir):
    return reconciling.valid_days(table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day")), "day", "2024-01-10", "2024-01-12").withColumn("day", F.col("day").cast("string"))


# Quality.


RULES = """(SELECT 'l_quantity_range' AS rule, count(*) FILTER (WHERE NOT l_quantity BETWEEN 1 AND 40) AS failures FROM lineitem
 UNION ALL SELECT 'l_tax_not_null', count(*) FILTER (WHERE l_tax IS NULL) FROM lineitem
 UNION ALL SELECT 'l_linenumber_type', count(*) FROM (DESCRIBE lineitem) WHERE column_name = 'l_linenumber' AND column_type <> 'INTEGER'
 UNION ALL SELECT 'l_quantity_mean', CASE WHEN avg(l_quantity) BETWEEN 30 AND 60 THEN 0 ELSE 1 END FROM lineitem
 UNION ALL SELECT 'l_returnflag_allowed', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
 UNION ALL SELECT 'columns', count(*) FROM (DESCRIBE lineitem) WHERE column_name = 'l_tax')"""


@query(f"SELECT rule, CAST(failures AS BIGINT) AS failures FROM {RULES}")
def quality_rules(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return quality.evaluate(df, _rules(df))


def _rules(df: DataFrame) -> list[quality.Rule]:
    return [quality.in_range("l_quantity", 1, 40), quality.not_null("l_tax"), quality.of_type(df, "l_linenumber", "int"), quality.mean_in_range("l_quantity", 30, 60), quality.allowed("l_returnflag", ["A", "N"]), quality.exact_columns(df, [c for c in df.columns if c != "l_tax"])]


@query(f"""SELECT count(*) AS evaluated, count(*) FILTER (WHERE failures = 0) AS successful, count(*) FILTER (WHERE failures <> 0) AS unsuccessful,
 round(100.0 * count(*) FILTER (WHERE failures = 0) / count(*), 2) AS percent, bool_and(failures = 0) AS success FROM {RULES}""")
def quality_summary(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return quality.summary(quality.evaluate(df, _rules(df)))


@query("SELECT l_orderkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_annotations(spark, sf_dir):
    return quality.repeats(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_suppkey"])


@query("""SELECT 'box_size' AS rule, count(*) FILTER (WHERE NOT (l_quantity > 0 AND l_linenumber > 0)) AS failures FROM lineitem
 UNION ALL SELECT 'box_inside', count(*) FILTER (WHERE NOT (l_discount * 100 >= 0 AND l_tax * 100 >= 0 AND l_discount * 100 + l_quantity <= 50 AND l_tax * 100 + l_linenumber <= 12)) FROM lineitem""")
def box_rules(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_quantity as w", "l_linenumber as h", "l_discount * 100 as x", "l_tax * 100 as y")
    return quality.evaluate(rows, quality.boxes("w", "h", "x", "y", 50, 12))


SPLIT = """(SELECT event_id, user_id, CASE WHEN b < 8 THEN 'train' WHEN b < 9 THEN 'val' ELSE 'test' END AS split FROM (SELECT event_id, user_id, CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 AS b FROM events))"""
SHARES = [("train", 8), ("val", 1), ("test", 1)]


@query(f"SELECT event_id, split FROM {SPLIT}")
def sequence_split(spark, sf_dir):
    return quality.sequence_split(table(spark, sf_dir, "events"), "user_id", SHARES).select("event_id", "split")


@query(f"""SELECT split, coalesce(n, 0) AS n_sequences, coalesce(m, 0) AS n_rows FROM (VALUES ('train'), ('val'), ('test')) v(split)
 LEFT JOIN (SELECT split, count(DISTINCT user_id) AS n, count(*) AS m FROM {SPLIT} GROUP BY 1) USING (split)""")
def split_sizes(spark, sf_dir):
    made = quality.sequence_split(table(spark, sf_dir, "events"), "user_id", SHARES)
    return quality.split_sizes(made, "user_id", [n for n, _ in SHARES])


@query("SELECT event_type AS class, count(*) AS n_rows FROM events GROUP BY 1")
def class_distribution(spark, sf_dir):
    return browse.rows_per(telemetry(spark, sf_dir), "class")


@query("""SELECT class, round(coalesce(a, 0), 9) AS share_raw, round(coalesce(b, 0), 9) AS share_kept, round(coalesce(b, 0) - coalesce(a, 0), 9) AS shift FROM
 (SELECT event_type AS class, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM events) AS a FROM events GROUP BY 1)
 FULL JOIN (SELECT event_type AS class, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM events WHERE value > 60) AS b FROM events WHERE value > 60 GROUP BY 1) USING (class)""")
def distribution_shift(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    made = reconciling.share_shift(t, t.where("altitude > 60"), "class")
    return made.select("class", *(F.round(c, 9).alias(c) for c in ("share_raw", "share_kept", "shift")))


@query("SELECT CAST((l_extendedprice >= 0)::INT + (l_extendedprice >= 20000)::INT + (l_extendedprice >= 60000)::INT AS INTEGER) AS bucket, count(*) AS n_rows FROM lineitem GROUP BY 1")
def size_buckets(spark, sf_dir):
    return quality.fixed_buckets(table(spark, sf_dir, "lineitem"), "l_extendedprice", [0, 20000, 60000])


# History, alerts, runs.


@query("SELECT user_id, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, sf_dir):
    return history.latest_per(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), "user_id", "ts", ["event_id"])


@query("""SELECT f.event_id, f.user_id, f.ts AS timestamp, (SELECT min(s.ts) FROM events s WHERE s.user_id = f.user_id AND s.event_type = 'purchase' AND s.ts > f.ts) AS resolved_at,
 CASE WHEN (SELECT min(s.ts) FROM events s WHERE s.user_id = f.user_id AND s.event_type = 'purchase' AND s.ts > f.ts) IS NULL THEN 'FAILURE' ELSE 'RESOLVED' END AS status
 FROM events f WHERE f.event_type = 'error'""")
def alerts_resolve(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").alias("timestamp"), "event_type")
    found = history.resolve_alerts(e.where("event_type = 'error'").drop("event_type"), e.where("event_type = 'purchase'").drop("event_type"), ["user_id"])
    return found.select("event_id", "user_id", "timestamp", "resolved_at", "status")


@query("SELECT event_id, user_id, previous, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events) WHERE previous <> event_type")
def status_transitions(spark, sf_dir):
    return history.status_changes(table(spark, sf_dir, "events"), ["user_id"], "ts", "event_type", ["event_id"]).select("event_id", "user_id", "previous", "event_type")


HOT = "(SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS job, event_type FROM events)"


def _hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by job, of which one has a third of all rows."""
    return table(spark, sf_dir, "events").select("event_id", "ts", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("job"), "event_type")


@query(f"""SELECT event_id, job, ts AS timestamp, least_later AS resolved_at, CASE WHEN least_later IS NULL THEN 'FAILURE' ELSE 'RESOLVED' END AS status FROM (
 SELECT *, min(ts) FILTER (WHERE event_type = 'purchase') OVER (PARTITION BY job ORDER BY epoch_us(ts) RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS least_later FROM {HOT} WHERE event_type IN ('error', 'purchase'))
 WHERE event_type = 'error'""")
def hot_job_resolved(spark, sf_dir):
    """Failures with their resolutions where one job has a third of all rows, which lie in several splits."""
    e = _hot(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    found = history.resolve_alerts(e.where("event_type = 'error'").drop("event_type"), e.where("event_type = 'purchase'").drop("event_type"), ["job"], scratch(spark, "resolve"))
    return found.select("event_id", "job", "timestamp", "resolved_at", "status")


@query(f"SELECT event_id, job, previous, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY job ORDER BY ts, event_id) AS previous FROM {HOT}) WHERE previous <> event_type")
def hot_job_transitions(spark, sf_dir):
    """Status changes where one job has a third of all rows, which lie in several splits."""
    return history.status_changes(_hot(spark, sf_dir), ["job"], "ts", "event_type", ["event_id"], scratch(spark, "changes")).select("event_id", "job", "previous", "event_type")


STATES = "(SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN 'FAILURE' WHEN event_type = 'purchase' THEN 'RESOLVED' ELSE 'STARTED' END AS status FROM events)"


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as job statuses."""
    kind = F.when(F.col("event_type") == "error", "FAILURE").when(F.col("event_type") == "purchase", "RESOLVED").otherwise("STARTED")
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", kind.alias("status"))


@query(f"""SELECT event_id, user_id, previous, status FROM (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM {STATES})
 WHERE previous <> status AND (status = 'FAILURE' OR previous = 'FAILURE' AND status = 'RESOLVED')""")
def alert_transitions(spark, sf_dir):
    return history.alert_changes(_states(spark, sf_dir), ["user_id"], "ts", "status", ["event_id"]).select("event_id", "user_id", "previous", "status")


@query(f"SELECT event_id, user_id, ts, status FROM {STATES} WHERE status = 'FAILURE'")
def active_alerts(spark, sf_dir):
    return _states(spark, sf_dir).where(filters.active(F.col("status")))


@query(f"SELECT * FROM {STATES} ORDER BY ts DESC, event_id LIMIT 500")
def alert_retention(spark, sf_dir):
    """Alerts appended in two loads; the newest 500 are kept."""
    path, rows = scratch(spark, "alerts"), _states(spark, sf_dir)
    history.append_newest(spark, rows.where("event_id % 3 <> 0"), path, "ts", ["event_id"])
    return history.append_newest(spark, rows.where("event_id % 3 = 0"), path, "ts", ["event_id"])


@query(f"""WITH one AS (SELECT user_id, arg_max(status, ts) AS status FROM {STATES} WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1),
 two AS (SELECT user_id, arg_max(status, ts) AS status FROM {STATES} WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1)
 SELECT user_id, two.status, one.status AS known FROM two LEFT JOIN one USING (user_id)
 WHERE two.status = 'FAILURE' AND one.status IS DISTINCT FROM 'FAILURE' OR two.status = 'RESOLVED' AND one.status = 'FAILURE'""")
def alert_stream_state(spark, sf_dir):
    """Two batches of statuses; the second is compared with the statuses that the first left behind."""
    path, rows = scratch(spark, "alert-state"), _states(spark, sf_dir).withColumnRenamed("ts", "timestamp").drop("event_id")
    arrivals.new_alerts(spark, rows.where("timestamp < timestamp'2024-01-15'"), path, ["user_id"])
    return arrivals.new_alerts(spark, rows.where("timestamp >= timestamp'2024-01-15'"), path, ["user_id"]).select("user_id", "status", "known")


@query(f"""SELECT user_id, ts AS timestamp, status, known FROM (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY ts, status) AS known FROM (SELECT DISTINCT user_id, ts, status FROM {STATES}))
 WHERE status = 'FAILURE' AND known IS DISTINCT FROM 'FAILURE' OR status = 'RESOLVED' AND known = 'FAILURE'""")
def alert_stream_keyed(spark, sf_dir):
    """Statuses arrive in two runs of a stream, the second with false failures that come late; every alert of every user, those within a batch too."""
    base, rows = scratch(spark, "alert-stream"), _states(spark, sf_dir).select("user_id", F.col("ts").cast("timestamp").alias("timestamp"), "status")
    late = rows.where("timestamp < timestamp'2024-01-10'").withColumn("status", F.lit("FAILURE"))
    parts = [rows.where("timestamp < timestamp'2024-01-15'"), rows.where("timestamp >= timestamp'2024-01-15'").unionByName(late)]
    for part in parts:
        part.write.mode("append").parquet(f"{base}/in")
        found = alerts.alert_stream(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), ["user_id"])
        found.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{base}/out")


@query(f"""SELECT user_id, status, ts FROM (SELECT user_id, max(ts) AS ts, arg_max(status, struct_pack(ts := ts, event_id := event_id)) AS status FROM {STATES} GROUP BY 1)""")
def versioned_state(spark, sf_dir):
    """The last status of every user, kept as a table of which each week's rows make a new version, of which two stay; a version that was written but not committed is passed over."""
    path, rows = scratch(spark, "state"), _states(spark, sf_dir)
    row = F.struct("ts", "event_id", "status")
    schema = rows.select("user_id", row.alias("top")).schema
    weeks = [None, *(datetime(2024, 1, d) for d in (8, 15, 22)), None]
    for low, high in zip(weeks, weeks[1:]):
        part = rows.where((F.lit(True) if low is None else F.col("ts") >= low) & (F.lit(True) if high is None else F.col("ts") < high))
        known = sinks.read_version(spark, path, schema)
        new = part.select("user_id", row.alias("top"))
        sinks.replace_version(spark, (new if known is None else known.unionByName(new)).groupBy("user_id").agg(F.max("top").alias("top")), path, keep=2)
    rows.limit(1).select("user_id", row.alias("top")).write.parquet(f"{path}/version=99")
    return sinks.read_version(spark, path, schema).select("user_id", "top.status", "top.ts")


@query("SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY 1 ORDER BY 2 DESC")
def status_counts(spark, sf_dir):
    return history.status_counts(table(spark, sf_dir, "orders"), "o_orderstatus").orderBy(F.desc("n_rows"))


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'O') AS succeeded, count(*) FILTER (WHERE o_orderstatus = 'F') AS failed,
 count(*) FILTER (WHERE o_orderstatus IN ('P')) AS in_progress, count(DISTINCT o_custkey) AS n_assets, count(DISTINCT o_orderpriority) AS n_flights FROM orders""")
def kpi_counts(spark, sf_dir):
    return history.run_kpis(table(spark, sf_dir, "orders"), "o_orderstatus", "O", "F", ["P"], "o_custkey", "o_orderpriority")


@query("SELECT max(ts) AS newest, count(*) AS n_alerts, count(*) FILTER (WHERE event_type = 'error') AS n_failed FROM events")
def alert_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return history.alert_summary(e.select(F.col("ts").alias("timestamp"), F.when(F.col("event_type") == "error", "FAILURE").otherwise("RESOLVED").alias("status")))


@query("SELECT event_id, event_type AS asset_key FROM events WHERE event_type IN ('view', 'click') AND CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) <= DATE '2024-01-11'")
def history_filter(spark, sf_dir):
    h = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("asset_key"), F.col("user_id").cast("string").alias("flight_id"), F.to_date("ts").alias("partition_date"))
    return h.where(filters.history_filter(["view", "click"], None, "2024-01-10", "2024-01-11")).select("event_id", "asset_key")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '2000-01-01' - INTERVAL 10 MINUTE THEN 'stale' WHEN o_orderstatus = 'P' THEN 'processing'
 WHEN o_orderstatus = 'F' AND o_orderkey % 5 < 3 THEN 'retry' WHEN o_orderstatus = 'F' THEN 'needs_review' ELSE 'done' END AS todo FROM orders""")
def retry_class(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "P", "processing").when(F.col("o_orderstatus") == "F", "verification_failed").otherwise("done")
    todo = history.retry_class(status, F.col("o_orderkey") % 5, F.lit(3), F.col("o_orderdate"), F.lit(datetime(2000, 1, 1)))
    return table(spark, sf_dir, "orders").select("o_orderkey", todo.alias("todo"))


@query("SELECT o_orderkey, round(epoch_us(o_orderdate + INTERVAL (o_orderkey % 977) SECOND - o_orderdate) / 1e6, 1) AS seconds FROM orders")
def run_seconds(spark, sf_dir):
    end = F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 977).cast("decimal(18,6)"))
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.seconds_between(F.col("o_orderdate"), end).alias("seconds"))


@query("SELECT CAST(day AS VARCHAR) AS day, n_rows, CAST(sum(n_rows) OVER (ORDER BY day) AS BIGINT) AS so_far FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows FROM events GROUP BY 1)")
def batch_running_total(spark, sf_dir):
    return history.running_rows(table(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("day")), "day")


@query("""SELECT 'telemetry' AS asset_key, 'curated' AS group_name, 'run-1' AS run_id, '2024-01-07' AS partition_date, 'all' AS flight_id, count(*) AS row_count,
 '{"n_classes":' || CAST(count(DISTINCT event_type) AS VARCHAR) || '}' AS metadata FROM events""")
def history_record(spark, sf_dir):
    row = history.history_row(telemetry(spark, sf_dir), "telemetry", "curated", "run-1", "2024-01-07", "all", F.struct(F.count_distinct("class").alias("n_classes")))
    path = scratch(spark, "history")
    history.record(row, path)
    return spark.read.schema(row.schema).parquet(path).withColumn("partition_date", F.col("partition_date").cast("string"))


# Sources and sinks: written to a shared folder and read back.


@query("SELECT CAST(s_suppkey AS DOUBLE) AS ts, CAST(s_nationkey AS DOUBLE) AS nation, s_acctbal AS balance FROM supplier")
def tab_roundtrip(spark, sf_dir):
    return _tab_round(spark, sf_dir, "none")


@query("SELECT CAST(s_suppkey AS DOUBLE) AS ts, CAST(s_nationkey AS DOUBLE) AS nation, s_acctbal AS balance FROM supplier")
def tab_compressed_scan(spark, sf_dir):
    return _tab_round(spark, sf_dir, "bzip2")


@query("SELECT CAST(s_suppkey AS DOUBLE) AS ts, CAST(s_nationkey AS DOUBLE) AS nation, s_acctbal AS balance FROM supplier")
def tab_zstd_scan(spark, sf_dir):
    path, _ = _tab_files(spark, sf_dir, "none", 3)
    sinks.zstd_copies(spark, path, f"{path}-zst")
    return readers.column_form(readers.good_rows(readers.wide_rows(spark, f"{path}-zst")), ["nation", "balance"])


def _tab_files(spark: SparkSession, sf_dir: str, codec: str, parts: int) -> tuple[str, list[str]]:
    path = scratch(spark, "tab")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("double"), F.col("s_nationkey").cast("double"), "s_acctbal")
    sinks.write_archive(rows, path, rows.columns, codec, parts)
    return path, rows.columns


def _tab_round(spark: SparkSession, sf_dir: str, codec: str) -> DataFrame:
    path, _ = _tab_files(spark, sf_dir, codec, 3)
    return readers.column_form(readers.good_rows(readers.wide_rows(spark, path)), ["nation", "balance"])


@query("SELECT CAST(s_suppkey AS DOUBLE) AS s_suppkey, CAST(s_nationkey AS DOUBLE) AS s_nationkey, s_acctbal FROM supplier")
def tab_through_csv(spark, sf_dir):
    """The same files through the CSV reader, which sees one phantom column more."""
    path, names = _tab_files(spark, sf_dir, "none", 2)
    return readers.tab_csv(spark, path, names)


@query("""SELECT line, 3 AS expected, CASE WHEN s_suppkey % 9 = 0 THEN 2 WHEN s_suppkey % 10 = 0 THEN 4 ELSE 3 END AS found FROM
 (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) + 1 AS line FROM supplier) WHERE s_suppkey % 9 = 0 OR s_suppkey % 10 = 0 OR s_suppkey % 11 = 0""")
def tab_bad_lines(spark, sf_dir):
    """One file with short rows, long rows and bad numbers, each reported with its line."""
    path, key = scratch(spark, "bad"), F.col("s_suppkey")
    fields = F.when(key % 9 == 0, F.array(key.cast("string"), F.lit("1"))).when(key % 10 == 0, F.array(key.cast("string"), F.lit("1"), F.lit("2"), F.lit("3"))).when(key % 11 == 0, F.array(key.cast("string"), F.lit("x"), F.lit("2"))).otherwise(F.array(key.cast("string"), F.lit("1"), F.lit("2")))
    lines = table(spark, sf_dir, "supplier").orderBy("s_suppkey").select(F.concat(F.array_join(fields, "\t"), F.lit("\t")).alias("value"))
    sinks.write_lines(lines.coalesce(1), path, "timestamp\tf0\tf1\t")
    return readers.bad_lines(spark, path).select("line", "expected", "found")


def _by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry whose flights are the event classes: few enough for a folder per day and flight."""
    return telemetry(spark, sf_dir).withColumn("flight_id", F.col("class"))


DAYS = "SELECT event_id, ts AS time, event_type AS flight_id, event_type AS class, value AS altitude, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date FROM events"


def _days(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    return sinks.read_days(spark, path, rows.withColumn("event_date", F.to_date("time")).schema).withColumn("event_date", F.col("event_date").cast("string"))


@query(DAYS)
def load_twice(spark, sf_dir):
    """A whole load, then one day once more: the other days stay, the day is not doubled."""
    path = scratch(spark, "days")
    rows = _by_class(spark, sf_dir)
    sinks.load_days(rows, path)
    sinks.load_days(rows.where("to_date(time) = date'2024-01-02'"), path)
    return _days(spark, path, rows)


@query("SELECT event_type AS class, count(*) AS n_rows FROM events GROUP BY 1")
def many_files(spark, sf_dir):
    path = scratch(spark, "many")
    sinks.query_layout(telemetry(spark, sf_dir), path)
    return browse.rows_per(readers.read_many(spark, path), "class")


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS class FROM events")
def csv_semicolon(spark, sf_dir):
    path = scratch(spark, "csv")
    telemetry(spark, sf_dir).select(F.col("event_id").alias(" event_id "), "class").write.csv(path, header=True, sep=";")
    return readers.delimited(spark, path).drop("_stem")


@query("SELECT event_id, event_type AS flight_id FROM events")
def csv_per_flight(spark, sf_dir):
    path = scratch(spark, "flights")
    sinks.export_per_flight(_by_class(spark, sf_dir).select("event_id", "flight_id"), path)
    return spark.read.schema("event_id long, flight_id string").csv(path, header=True)


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS class, user_id % 2 = 0 AS semicolon FROM events")
def csv_mixed_delimiters(spark, sf_dir):
    """A folder of comma and semicolon files, each read by its own delimiter."""
    path, rows = scratch(spark, "mixed"), telemetry(spark, sf_dir)
    for part, sep in (("cast(flight_id as long) % 2 = 0", ";"), ("cast(flight_id as long) % 2 = 1", ",")):
        rows.where(part).select("event_id", "class", F.lit(sep == ";").cast("string").alias("semicolon")).write.mode("append").csv(path, header=True, sep=sep)
    return readers.delimited(spark, path).drop("_stem").withColumn("semicolon", F.col("semicolon").cast("boolean"))


@query("""SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, kind FROM (SELECT event_id, ts, unnest(['csv', 'parquet']) AS kind FROM events) WHERE CAST(ts AS DATE) = DATE '2024-01-09'""")
def read_by_suffix(spark, sf_dir):
    """One table as CSV and as parquet, each by its suffix, the day's rows of either."""
    base, rows = scratch(spark, "suffix"), table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("time"))
    rows.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS")).write.csv(f"{base}/day.csv", header=True)
    rows.write.parquet(f"{base}/day.parquet")
    found = [cleaning.raw_day(readers.read_any(spark, f"{base}/day.{kind}"), "2024-01-09", " F1 ").select(F.col("event_id").cast("long").alias("event_id"), F.to_date("time").cast("string").alias("day"), F.lit(kind).alias("kind"), "flight_id") for kind in ("csv", "parquet")]
    return found[0].unionByName(found[1]).where("flight_id = 'F1'").drop("flight_id")


@query("SELECT event_id, ts AS time, 'telemetry_' || event_type AS flight_id FROM events")
def flight_from_file(spark, sf_dir):
    """Flights named by the files that their rows came from; a column of that name is replaced."""
    base = scratch(spark, "stems")
    rows = telemetry(spark, sf_dir).select("event_id", "time", F.lit("other").alias("flight_id"), F.concat(F.lit("telemetry_"), "class").alias("file"))
    rows.write.partitionBy("file").parquet(base)
    named = readers.read_many(spark, base).withColumn("_stem", F.regexp_extract("source_file", "file=([^/]+)/", 1))
    cleaning.require(named, ["time"])
    return cleaning.with_flight(named, "  ").drop("source_file", "file")


@query(f"SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS status, CASE WHEN event_id % 4 <> 0 THEN ts END AS timestamp FROM events")
def alerts_json(spark, sf_dir):
    """Alert files, each one JSON array, some times unreadable."""
    path = scratch(spark, "json")
    when = F.when(F.col("event_id") % 4 == 0, "no time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    rows = table(spark, sf_dir, "events").select(F.struct(when.alias("timestamp"), F.col("event_type").alias("status"), F.col("user_id").cast("string").alias("run_id")).alias("alert"), (F.col("event_id") / 1000).cast("long").alias("file"))
    files = rows.groupBy("file").agg(F.to_json(F.collect_list("alert")).alias("value"))  # bounded: 1,000 alerts a file
    files.write.partitionBy("file").text(path)
    return readers.read_alerts(spark, path).select("run_id", "status", "timestamp")


@query("SELECT ts FROM events ORDER BY event_id LIMIT 1")
def first_row_time(spark, sf_dir):
    path = scratch(spark, "peek")
    table(spark, sf_dir, "events").orderBy("event_id").coalesce(1).write.parquet(path)
    return readers.first_time(spark.read.parquet(path), "ts")


@query("SELECT s_suppkey, s_name, CAST('none' AS VARCHAR) AS phone, 0 AS tier, s_suppkey % 2 = 0 AS late FROM supplier")
def table_with_defaults(spark, sf_dir):
    """A table made if it isn't there, a column added with a default, rows written before and after, read by name."""
    name, supplier = f"wideskein_{uuid.uuid4().hex}", table(spark, sf_dir, "supplier")
    for _ in range(2):
        sinks.ensure_table(spark, name, "s_suppkey BIGINT, s_name STRING, phone STRING DEFAULT 'none'")
    supplier.where("s_suppkey % 2 = 1").select("s_suppkey", "s_name").createOrReplaceTempView(f"{name}_a")
    spark.sql(f"INSERT INTO {name} (s_suppkey, s_name) SELECT * FROM {name}_a")
    for _ in range(2):
        sinks.ensure_column(spark, name, "tier", "INT", "0")
    supplier.where("s_suppkey % 2 = 0").select("s_suppkey", "s_name").createOrReplaceTempView(f"{name}_b")
    spark.sql(f"INSERT INTO {name} (s_suppkey, s_name) SELECT * FROM {name}_b")
    return readers.named_table(spark, name).select("s_suppkey", "s_name", "phone", "tier", (F.col("s_suppkey") % 2 == 0).alias("late"))


@query("""SELECT * FROM (VALUES ('l_orderkey'), ('l_linenumber'), ('l_quantity'), ('l_discount')) v(name) JOIN (
 SELECT column_name AS name, CASE column_type WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS type, column_name = 'l_discount' AS has_default FROM (DESCRIBE lineitem)) USING (name)""")
def table_described(spark, sf_dir):
    """Names, types and defaults of a table that holds the rows; an unknown table has none."""
    name, columns = f"wideskein_{uuid.uuid4().hex}", "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_discount DOUBLE DEFAULT 0.0"
    sinks.ensure_table(spark, name, columns)
    table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount").write.insertInto(name)
    found = readers.describe_table(spark, name).unionByName(readers.describe_table(spark, f"{name}_none"))
    return found.select("name", "type", F.col("default").isNotNull().alias("has_default"))


@query("""SELECT codec, count(*) AS n_rows, CAST(sum(CAST(l_quantity AS DECIMAL(28,6))) AS DOUBLE) AS total FROM lineitem, (VALUES ('zstd'), ('snappy'), ('gzip'), ('none')) v(codec) GROUP BY 1""")
def columnar_codecs(spark, sf_dir):
    """Each codec written in small files and read back."""
    base, rows, back = scratch(spark, "codecs"), table(spark, sf_dir, "lineitem").select("l_quantity"), None
    for codec in sorted(sinks.CODECS):
        sinks.write_columnar(rows, f"{base}/{codec}", codec, rows_per_file=100_000, block_mb=8)
        one = spark.read.parquet(f"{base}/{codec}").withColumn("codec", F.lit(codec))
        back = one if back is None else back.unionByName(one)
    return back.groupBy("codec").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("l_quantity").cast("decimal(28,6)")).cast("double").alias("total"))


@query("SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_quantity FROM lineitem")
def cast_and_copy(spark, sf_dir):
    path = scratch(spark, "cast")
    sinks.cast_copy(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), path)
    return spark.read.parquet(path)


@query(f"""SELECT count(*) AS evaluated, round(100.0 * count(*) FILTER (WHERE failures = 0) / count(*), 2) AS percent, bool_and(failures = 0) AS success,
 count(*) FILTER (WHERE failures = 0) AS successful, count(*) FILTER (WHERE failures <> 0) AS unsuccessful FROM {RULES}""")
def report_json(spark, sf_dir):
    """The summary of the rules as a JSON report, read back; its keys are in order."""
    path, df = scratch(spark, "report"), table(spark, sf_dir, "lineitem")
    sinks.write_report(quality.summary(quality.evaluate(df, _rules(df))), path)
    return spark.read.json(path)


@query("SELECT n // 7 + CASE WHEN part < n % 7 THEN 1 ELSE 0 END AS n_rows FROM (SELECT count(*) AS n FROM events), range(7) AS r(part)")
def split_round_robin(spark, sf_dir):
    path = scratch(spark, "parts")
    sinks.split_parts(table(spark, sf_dir, "events").select("event_id"), path, 7)
    return spark.read.csv(path, header=True).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows")


@query("SELECT strftime(ts, '%Y%m') AS year_month, count(*) AS n_rows, 0 AS n_out_of_order FROM events GROUP BY 1")
def sorted_within_files(spark, sf_dir):
    """Rows of the query layout by month, and how many of them come before the one that stands before them in their file."""
    path = scratch(spark, "layout")
    sinks.query_layout(telemetry(spark, sf_dir), path)
    rows = readers.read_many(spark, path).select("flight_id", "time", "source_file", F.monotonically_increasing_id().alias("at"))
    before = F.lag(F.struct("flight_id", "time")).over(Window.partitionBy("source_file").orderBy("at"))
    seen = rows.select(F.regexp_extract("source_file", r"year_month=(\d+)", 1).alias("year_month"), F.coalesce(F.struct("flight_id", "time") < before, F.lit(False)).alias("wrong"))
    return seen.groupBy("year_month").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("wrong").cast("int").alias("n_out_of_order"))


@query("SELECT strftime(min(ts), '%Y%m%dT%H%M%S') AS first, strftime(max(ts), '%Y%m%dT%H%M%S') AS last, count(*) AS n_rows FROM events WHERE value > 60")
def export_named_by_range(spark, sf_dir):
    """One CSV file whose name says from when to when its rows are."""
    path = sinks.export_range_csv(telemetry(spark, sf_dir).where("altitude > 60").select("event_id", "time"), scratch(spark, "export"), "telemetry")
    back = spark.read.csv(path, header=True)
    return back.groupBy(F.regexp_extract(F.col("_metadata.file_path"), r"telemetry_(\d+T\d+)_", 1).alias("first"), F.regexp_extract(F.col("_metadata.file_path"), r"_(\d+T\d+)/", 1).alias("last")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT event_id AS \"Event\", event_type AS \"Class\", value AS altitude FROM events")
def display_names(spark, sf_dir):
    return browse.renamed(telemetry(spark, sf_dir).select("event_id", "class", "altitude"), {"event_id": "Event", "class": "Class", "roll": "Roll"})


@query("SELECT user_id, string_agg(event_type, ', ' ORDER BY event_type) AS classes FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1")
def joined_classes(spark, sf_dir):
    """The distinct classes of a flight as one text; there are few."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(scalars.joined_text(F.array_sort(F.collect_set("event_type"))).alias("classes"))


STREAM_KEYS = ["flight_id", "time", "event_id"]


CALENDAR = ("2024-01-02", "2024-12-31")


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Files arrive in three steps, the first once more under another name with other altitudes; rows before the calendar go to quarantine.

    A step has as many files as its scan has tasks, up to the hundred that a batch takes.
    """
    base = scratch(spark, "stream")
    rows = _by_class(spark, sf_dir)
    log = progress.BatchLog(spark, f"{base}/log")
    spark.streams.addListener(log)
    try:
        for part, more in (("event_id % 2 = 0", -1), ("event_id % 2 = 0", 0), ("event_id % 2 = 1", 0)):
            rows.where(part).withColumn("altitude", F.col("altitude") + more).coalesce(2).write.mode("append").parquet(f"{base}/in")
            stream = arrivals.arriving(spark, f"{base}/in", rows.schema)
            running = arrivals.load_arrivals(stream, f"{base}/table", f"{base}/late", f"{base}/checkpoint", *CALENDAR)
            running.awaitTermination()
            log.wait(running)
    finally:
        spark.streams.removeListener(log)
    return base, rows


@query(f"{DAYS} WHERE CAST(ts AS DATE) >= DATE '2024-01-02'")
def stream_new_files(spark, sf_dir):
    """What the table holds in the end: of every key the row that came last."""
    base, rows = _streamed(spark, sf_dir)
    return arrivals.settled(spark, f"{base}/table", rows.schema, STREAM_KEYS).withColumn("event_date", F.col("event_date").cast("string"))


@query("""SELECT 0 AS batch, count(*) AS n_rows FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 1, count(*) FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 2, count(*) FROM events WHERE event_id % 2 = 1""")
def stream_batch_log(spark, sf_dir):
    """The health log of the batches, as the table that the listener wrote: how many rows each read."""
    base, _ = _streamed(spark, sf_dir)
    return progress.batch_log(spark, f"{base}/log").where("rows > 0").select(F.col("batch").cast("int").alias("batch"), F.col("rows").alias("n_rows"))


@query("""WITH late AS (SELECT event_id, value - 1 AS altitude, 0 AS batch FROM events WHERE event_id % 2 = 0 AND CAST(ts AS DATE) < DATE '2024-01-02'
  UNION ALL SELECT event_id, value, 2 - (event_id + 1) % 2 FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-02')
 SELECT 'refused before' AS state, event_id, altitude, batch FROM late
 UNION ALL SELECT 'loaded after', event_id, value, 2 - (event_id + 1) % 2 FROM events UNION ALL SELECT 'refused after', event_id, altitude, batch FROM late WHERE false""")
def stream_quarantine(spark, sf_dir):
    """Rows that the calendar refused, with their batch; then the calendar grows by a day, they are taken back twice, and all rows are in the table once."""
    base, rows = _streamed(spark, sf_dir)
    table_, late, wider = f"{base}/table", f"{base}/late", ("2024-01-01", "2024-12-31")
    state = lambda df, name: df.select(F.lit(name).alias("state"), "event_id", "altitude", "batch")
    before = state(arrivals.refused(spark, late, rows.schema, *CALENDAR), "refused before")
    taken = [arrivals.redrive(spark, late, table_, rows.schema, CALENDAR, wider) for _ in range(2)]
    if taken[0] != taken[1]:
        raise RuntimeError(f"taken back twice, but not the same rows: {taken}")
    held = arrivals.settled(spark, table_, rows.schema, STREAM_KEYS, batch=True)
    return before.unionByName(state(held, "loaded after")).unionByName(state(arrivals.refused(spark, late, rows.schema, *wider), "refused after"))


@query("SELECT event_id, ts AS time, event_type AS class FROM events")
def stream_without_repeats(spark, sf_dir):
    """Every row delivered twice, within the watermark, comes out once."""
    base, rows = scratch(spark, "again"), telemetry(spark, sf_dir).select("event_id", F.col("time").cast("timestamp").alias("time"), "class")
    rows.unionByName(rows).write.parquet(f"{base}/in")
    stream = arrivals.without_repeats(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), ["event_id"], "40 days")
    stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/out")


@query("""SELECT count(*) AS n_rows, count(*) AS rows_in_files, CAST(sum(CAST(l_quantity AS DECIMAL(28,6))) AS DOUBLE) AS total, true AS measured FROM lineitem""")
def write_metrics(spark, sf_dir):
    """Rows counted while they are written, against the rows in the files that have a size and a checksum of their own.

    Files, and so the tasks that write them and those that digest them, are of Spark's advised size; their number grows with the table.
    """
    path, source = scratch(spark, "metrics"), f"{sf_dir}/lineitem.parquet"
    read = sinks.file_sizes(spark, source).agg(F.sum("bytes")).first()[0]
    made = sinks.observed_write(spark.read.parquet(source).hint("rebalance", "l_orderkey"), path, time.time(), time.time, read)
    files = sinks.file_sizes(spark, path).join(checksums.file_checksums(spark, path), ["file", "bytes"]).where("bytes > 0 and length(sha256) = 64").select(F.regexp_extract("file", "[^/]+$", 0).alias("name"))
    rows = spark.read.parquet(path).select("l_quantity", F.col("_metadata.file_name").alias("name")).join(F.broadcast(files), "name")  # a row a file
    measured = made["bytes_in"] > 0 and made["bytes_out"] > 0 and abs(made["ratio"] - made["bytes_in"] / made["bytes_out"]) < 1e-9 and made["rows_per_s"] > 0
    return rows.agg(F.lit(made["rows"]).cast("long").alias("n_rows"), F.count(F.lit(1)).alias("rows_in_files"), F.sum(F.col("l_quantity").cast("decimal(28,6)")).cast("double").alias("total"), F.lit(measured).alias("measured"))


LINES = "(SELECT event_id // 2000 AS part, CAST(event_id AS VARCHAR) || ' ' || event_type || ' ' || CAST(user_id AS VARCHAR) || chr(10) AS line, event_id FROM events)"


@query(f"""WITH files AS (SELECT part, string_agg(line, '' ORDER BY event_id) AS content FROM {LINES} GROUP BY 1),
 leaves AS (SELECT part, i, sha256(substr(content, CAST(i * 4096 + 1 AS BIGINT), 4096)) AS digest FROM files, LATERAL (SELECT unnest(range(0, greatest(1, (length(content) + 4095) // 4096))) AS i)),
 one AS (SELECT part, i // 4 AS i, sha256(string_agg(digest, '' ORDER BY i)) AS digest, count(*) OVER (PARTITION BY part) AS width FROM leaves GROUP BY part, i // 4),
 two AS (SELECT part, i // 4 AS i, CASE WHEN any_value(width) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest, count(*) OVER (PARTITION BY part) AS width FROM one GROUP BY part, i // 4),
 three AS (SELECT part, CASE WHEN any_value(width) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest FROM two GROUP BY part)
 SELECT CAST(part AS BIGINT) AS part, length(content) AS bytes, sha256(content) AS sha256, digest AS tree FROM files JOIN three USING (part)""")
def checksum_trees(spark, sf_dir):
    """Files of 2,000 lines, each with the digest of its bytes and the root of a tree over pieces of 4 KiB (three levels of four)."""
    path = scratch(spark, "lines")
    e = table(spark, sf_dir, "events").select((F.col("event_id") / 2000).cast("long").alias("part"), "event_id", F.concat_ws(" ", "event_id", "event_type", "user_id").alias("value"))
    e.repartition("part").sortWithinPartitions("part", "event_id").drop("event_id").write.partitionBy("part").text(path)
    trees = checksums.file_trees(spark, path, 4096, 4).withColumnRenamed("digest", "tree")
    both = checksums.file_checksums(spark, path).join(trees, ["file", "bytes"])
    return both.select(F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part"), "bytes", "sha256", "tree")


@query("""SELECT '1.0' AS pipeline_version, 'r1' AS revision, 'a, b' AS batches, 'events' AS path, count(*) AS row_count,
 sha256('{"col_sum":[' || CAST(CAST(round(sum(CAST(value AS DECIMAL(28,6))), 4) AS DECIMAL(38,4)) AS VARCHAR) || '],"row_count":' || CAST(count(*) AS VARCHAR) || '}') AS content_fingerprint FROM events""")
def lineage_row(spark, sf_dir):
    made = profiling.fingerprint(profiling.profile_narrow(table(spark, sf_dir, "events"), ["value"]))
    return history.lineage(made, "1.0", "r1", ["a", "b"], "events")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql}
