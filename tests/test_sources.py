"""Wide tab files, delimited files, alerts and sinks on hand-written inputs."""

import pytest
from pyspark.sql import functions as F

from wideskein.functions import filters, scalars
from wideskein.operators import cleaning, history, profiling, quality, reconciling
from wideskein.sources import readers, sinks

HEADER = "timestamp\tf0\tb0\t\n"


def write(path, *lines):
    path.write_text(HEADER + "".join(lines))
    return str(path)


def test_tab_rows_with_and_without_trailing_tab_and_crlf(spark, tmp_path):
    path = write(tmp_path / "a.tab", "0.036000000000000004\t1.5\t0\t\n", "0.1\t2\t1\n", "0.2\t3\t1\t\r\n")
    rows = readers.good_rows(readers.wide_rows(spark, path)).orderBy("ts").collect()
    assert [(r.ts, list(r["values"])) for r in rows] == [(0.036000000000000004, [1.5, 0.0]), (0.1, [2.0, 1.0]), (0.2, [3.0, 1.0])]
    names = readers.sensor_names(spark, path).orderBy("pos").collect()
    assert [(r.pos, r.name) for r in names] == [(0, "f0"), (1, "b0")]


@pytest.mark.parametrize("line", ["0.1\t2\t\n", "0.1\t2\t1\t4\t\n", "0.1\tx\t1\t\n", "\n"])
def test_bad_rows_are_reported_not_loaded(spark, tmp_path, line):
    path = write(tmp_path / "a.tab", line, "0.5\t1\t1\t\n")
    rows = readers.wide_rows(spark, path)
    assert readers.bad_rows(rows).count() == 1
    assert readers.good_rows(rows).count() == 1
    with pytest.raises(Exception, match="bad row"):
        readers.strict_rows(rows).select("values").collect()


def test_files_of_different_width_and_timestamp_choices(spark, tmp_path):
    write(tmp_path / "a.tab", "1\t2\t3\t\n")
    (tmp_path / "b.tab").write_text("x\ty\n5\t6\n")
    rows = readers.wide_rows(spark, str(tmp_path), "y")
    assert readers.bad_rows(rows).count() == 0
    by_name = {len(r["values"]): r.ts for r in readers.good_rows(rows).collect()}
    assert by_name == {1: 6.0, 3: None}
    assert {len(r["values"]) for r in readers.good_rows(readers.wide_rows(spark, str(tmp_path), None)).collect()} == {3, 2}


def test_headers_inside_a_file_and_line_numbers(spark, tmp_path):
    path = write(tmp_path / "a.tab", *(f"{i}\t2\t1\t\n" for i in range(400)), HEADER, "1\t2\t\n", *(f"{i}\t2\t1\t\n" for i in range(300)), "x\t2\t1\n")
    for size in ("128m", "1000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = sorted((r.line, r.expected, r.found, r["sample"]) for r in readers.bad_lines(spark, path).collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert found == [(402, 3, 3, "timestamp\tf0\tb0"), (403, 3, 2, "1\t2"), (704, 3, 3, "x\t2\t1")]


def test_one_key_with_very_many_alerts(spark):
    """A million rows of one key: the time grows with the rows, not with their square."""
    import time

    rows = spark.range(1_000_000).select(F.lit("k").alias("job"), F.timestamp_seconds(F.col("id")).alias("timestamp"), "id")
    started = time.time()
    found = history.resolve_alerts(rows.where("id % 4 <> 0"), rows.where("id % 4 = 0").drop("id"), ["job"])
    assert found.where("status = 'RESOLVED' and unix_seconds(resolved_at) = (id div 4 + 1) * 4 or status = 'FAILURE' and id > 999996").count() == 750_000
    assert time.time() - started < 60


def test_alerts_without_time_and_of_one_instant(spark):
    bad = spark.sql("SELECT * FROM VALUES ('a', timestamp'2026-01-01 00:00:00', 1), ('a', null, 2), ('b', timestamp'2026-01-02 00:00:00', 3) AS t(job, timestamp, n)")
    good = spark.sql("SELECT * FROM VALUES ('a', timestamp'2026-01-01 00:00:00'), ('a', timestamp'2026-01-03 00:00:00'), ('a', timestamp'2026-01-02 00:00:00'), ('b', null) AS t(job, timestamp)")
    got = {r.n: (r.status, r.resolved_at and r.resolved_at.day) for r in history.resolve_alerts(bad, good, ["job"]).collect()}
    assert got == {1: ("RESOLVED", 2), 2: ("FAILURE", None), 3: ("FAILURE", None)}


def test_newest_alerts_are_kept_and_an_empty_load_changes_nothing(spark, tmp_path):
    path, rows = str(tmp_path / "alerts"), spark.range(20).toDF("timestamp")
    for part in (rows, rows.limit(0), spark.range(20, 23).toDF("timestamp")):
        kept = history.append_newest(spark, part, path, "timestamp", [], keep=5)
    assert sorted(r.timestamp for r in kept.collect()) == [18, 19, 20, 21, 22]


def test_tables_are_made_once_and_grow(spark):
    with pytest.raises(ValueError, match="no table"):
        readers.named_table(spark, "not_there")
    spark.sql("DROP TABLE IF EXISTS grown")
    sinks.ensure_table(spark, "grown", "a INT")
    spark.sql("INSERT INTO grown VALUES (1)")
    sinks.ensure_column(spark, "grown", "b", "STRING", "'x'")
    sinks.ensure_column(spark, "grown", "b", "STRING", "'y'")
    assert readers.named_table(spark, "grown").first() == (1, "x")
    assert [tuple(r) for r in readers.describe_table(spark, "grown").collect()] == [("a", "int", True, None), ("b", "string", True, "'x'")]
    assert readers.describe_table(spark, "not_there").count() == 0


def test_copies_with_swapped_values_are_not_close(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "k int, v double")
    b = spark.createDataFrame([(1, 2.0), (2, 1.0), (3, None)], "k int, v double")
    r = reconciling.compare_copies(a, b, ["k"], ["v"]).first()
    assert (r.sum_a, r.sum_b, r.max_abs_diff, r.close, r.rows_a) == (3.0, 3.0, 1.0, False, 3)
    assert reconciling.compare_copies(a, a, ["k"], ["v"]).first().close and not reconciling.compare_copies(a, a.where("k < 3"), ["k"], ["v"]).first().close


def test_nan_is_counted_then_null(spark, tmp_path):
    path = write(tmp_path / "a.tab", "0.1\tNaN\t1\t\n", "0.2\t4\t1\t\n")
    profiled = profiling.profile(profiling.wide_form(readers.good_rows(readers.wide_rows(spark, path))), ["file", "pos"])
    first = profiled.where("pos = 0").first()
    assert (first.n, first.n_nan, float(first.total), first.low) == (1, 1, 4.0, 4.0)
    assert {r.pos: r["class"] for r in profiling.classes(profiled).collect()} == {0: "byte_safe", 1: "constant_one"}


def test_tab_csv_drops_the_phantom_column(spark, tmp_path):
    path = write(tmp_path / "a.tab", "0.1\t2\t1\t\n")
    df = readers.tab_csv(spark, path, ["timestamp", "f0", "b0"])
    assert df.columns == ["timestamp", "f0", "b0"] and df.first() == (0.1, 2.0, 1.0)


@pytest.mark.parametrize("codec", ["bzip2", "gzip", "none"])
def test_archive_round_trip_is_exact(spark, tmp_path, codec):
    df = spark.range(20).select((F.col("id") * 0.1).alias("ts"), (F.col("id") / 3).alias("a"), (F.col("id") % 2).cast("double").alias("b"))
    path = str(tmp_path / "out")
    sinks.write_archive(df, path, df.columns, codec, parts=3)
    back = readers.column_form(readers.good_rows(readers.wide_rows(spark, path)), ["a", "b"])
    assert reconciling.difference(df, back).count() == 0


def test_fingerprint_ignores_partitions_and_sees_one_cell(spark):
    df = spark.range(500).select((F.col("id") * 0.1).alias("a"), F.col("id").cast("double").alias("b"))
    print_of = lambda d: profiling.fingerprint(profiling.profile(profiling.long_form(d, ["a", "b"]), ["pos"])).first()[1]
    assert print_of(df) == profiling.fingerprint(profiling.profile_narrow(df, ["a", "b"])).first()[1]
    assert print_of(df) == print_of(df.repartition(7))
    assert print_of(df) != print_of(df.withColumn("b", F.when(F.col("b") == 77, 77.001).otherwise(F.col("b"))))


def test_read_any_and_delimiters(spark, tmp_path):
    (tmp_path / "telemetry_013.csv").write_text(" time ; altitude \n2026-01-02 03:04:05;7\n")
    df = cleaning.raw_day(readers.read_any(spark, str(tmp_path / "telemetry_013.csv")), "2026-01-02")
    assert df.columns == ["time", "altitude", "flight_id"] and df.first().flight_id == "telemetry_013"
    assert cleaning.raw_day(readers.read_any(spark, str(tmp_path / "telemetry_013.csv")), "2026-01-03", " F7 ").count() == 0
    with pytest.raises(ValueError, match="neither"):
        readers.read_any(spark, "x.txt")
    with pytest.raises(ValueError, match="missing"):
        cleaning.raw_day(spark.createDataFrame([(1, "a")], "x int, _stem string"), "2026-01-03")


def test_alerts(spark, tmp_path):
    assert readers.read_alerts(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "a.json").write_text('[{"timestamp":"2026-01-01T00:00:00","status":"FAILURE"},{"timestamp":"bad","status":"X"},{"timestamp":"2026-01-02T00:00:00","status":"RESOLVED"}]')
    assert [r.status for r in readers.read_alerts(spark, str(tmp_path / "a.json")).collect()] == ["RESOLVED", "FAILURE", "X"]
    (tmp_path / "b.json").write_text("{not json")
    assert readers.read_alerts(spark, str(tmp_path / "b.json")).count() == 0


def test_reloads_are_idempotent_and_empty_loads_change_nothing(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.sql("SELECT timestamp'2026-01-01 01:00:00' + make_interval(0,0,0,cast(id % 3 as int)) AS time, concat('00', id % 2) AS flight_id, id FROM range(12)")
    sinks.load_days(rows, path)
    sinks.load_days(rows, path)
    sinks.load_days(rows.limit(0), path)
    sinks.load_days(rows.where("flight_id = '001'"), path)
    back = sinks.read_days(spark, path, "time timestamp, id long, event_date date, flight_id string")
    assert back.count() == 12 and {r.flight_id for r in back.select("flight_id").distinct().collect()} == {"000", "001"}


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("", 2)], "flight_id string, n int")
    sinks.export_csv(df, str(tmp_path / "x"), bom=True)
    file = next((tmp_path / "x").glob("part-*"))
    assert file.read_bytes().startswith(b"\xef\xbb\xbf")
    sinks.export_per_flight(df, str(tmp_path / "y"))
    assert [p.name for p in (tmp_path / "y").glob("flight_id=*")] == ["flight_id=a"]
    with pytest.raises(ValueError, match="codec"):
        sinks.write_columnar(df, str(tmp_path / "z"), "lz4")
    sinks.split_parts(spark.range(30).toDF("n"), str(tmp_path / "s"), 3)
    assert sorted(len(p.read_text().splitlines()) for p in (tmp_path / "s").glob("part-*")) == [11, 11, 11]


def test_filters_skip_what_they_do_not_know(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (None,)], "altitude double")
    parts = filters.value_filters(df, [{"column": "no", "op": "<", "value": 1}, {"column": "altitude", "op": "~", "value": 1}, {"column": "altitude", "op": "<", "value": None}])
    assert not parts and df.where(filters.all_of(parts)).count() == 3
    with pytest.raises(ValueError):
        filters.recent(F.col("t"), "year", F.current_timestamp())


def test_scalars(spark):
    row = spark.createDataFrame([(300.0, 1.5, 7.0)], "a double, b double, c double").select(*(scalars.byte_or_null(F.col(c)).alias(c) for c in "abc")).first()
    assert tuple(row) == (None, None, 7)
    assert spark.sql("SELECT '{\"b\":1}' AS a, 'x{' AS b").select(scalars.json_or_text(F.col("a")), scalars.json_or_text(F.col("b"))).first() == ('{"b":1}', "x{")


def test_rules_report_everything_before_failing(spark):
    df = spark.createDataFrame([(0, 5), (101, None), (50, 7)], "feat_A int, feat_B int")
    rules = [quality.in_range("feat_A", 1, 100), quality.not_null("feat_B"), quality.mean_in_range("feat_A", 30, 60), quality.exact_columns(df, ["feat_A", "feat_B"])]
    results = quality.evaluate(df, rules)
    assert {r.rule: r.failures for r in results.collect()} == {"feat_A_range": 2, "feat_B_not_null": 1, "feat_A_mean": 0, "columns": 0}
    summary = quality.summary(results).first()
    assert (summary.evaluated, summary.successful, summary.success) == (4, 2, False)
    with pytest.raises(ValueError, match="feat_A_range"):
        quality.enforce(results)


def test_history_write_does_not_fail_the_run(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    assert history.record(spark.range(1), str(tmp_path / "file" / "sub")) is False
