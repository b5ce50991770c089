"""Arrivals: each file once, replays without repeats, rows out of the calendar in quarantine."""

from pyspark.sql import functions as F

from wideskein.sources import sinks
from wideskein.streaming import alerts, arrivals, progress

SCHEMA = "time timestamp, flight_id string, altitude double"


def test_arrivals(spark, tmp_path):
    base = str(tmp_path)
    one = spark.sql("SELECT timestamp'2026-01-05 10:00:00' AS time, '001' AS flight_id, 1.0D AS altitude UNION ALL SELECT timestamp'2020-01-01 00:00:00', '001', 2.0D UNION ALL SELECT null, '001', 3.0D")
    two = spark.sql("SELECT timestamp'2026-01-05 11:00:00' AS time, '001' AS flight_id, 4.0D AS altitude UNION ALL SELECT timestamp'2026-01-06 11:00:00', '002', 5.0D")

    def arrive(df):
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
        query = arrivals.load_arrivals(arrivals.arriving(spark, f"{base}/in", one.schema), f"{base}/table", f"{base}/late", f"{base}/cp", "2026-01-01", "2026-12-31")
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress]

    assert sum(arrive(one)) == 3
    arrive(two)
    arrive(one)
    corrected = two.where("altitude = 4").withColumn("altitude", F.lit(4.5))
    arrive(corrected)
    keys = ["flight_id", "time"]
    table = arrivals.settled(spark, f"{base}/table", one.schema, keys)
    assert sorted((r.flight_id, r.altitude) for r in table.collect()) == [("001", 1.0), ("001", 4.5), ("002", 5.0)]
    arrivals.compact(spark, f"{base}/table", one.schema, keys, f"{base}/compact")
    assert sinks.read_days(spark, f"{base}/compact", SCHEMA + ", event_date date").count() == 3
    assert {r.altitude for r in spark.read.parquet(f"{base}/late").collect()} == {2.0, 3.0}


def test_new_alerts_and_stream_dedup(spark, tmp_path):
    state = str(tmp_path / "state")
    batch = spark.createDataFrame([("j", "s", "FAILURE", 1), ("k", "s", "SUCCESS", 1)], "job_name string, step_name string, status string, timestamp int")
    assert [r.job_name for r in arrivals.new_alerts(spark, batch, state, ["job_name", "step_name"]).collect()] == ["j"]
    later = batch.withColumn("status", F.lit("RESOLVED")).where("job_name = 'j'")
    assert arrivals.new_alerts(spark, later, state, ["job_name", "step_name"]).first().known == "FAILURE"
    again = batch.withColumn("status", F.lit("FAILURE"))
    assert sorted(r.job_name for r in arrivals.new_alerts(spark, again, state, ["job_name", "step_name"]).collect()) == ["j", "k"]
    assert arrivals.new_alerts(spark, again, state, ["job_name", "step_name"]).count() == 0
    spark.sql("SELECT timestamp'2026-01-05 10:00:00' AS time, 'a' AS k FROM range(3)").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("time timestamp, k string").parquet(str(tmp_path / "in"))
    query = arrivals.without_repeats(stream, ["k"]).writeStream.format("memory").queryName("dedup").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("dedup").count() == 1


STATUSES = "job string, step string, status string, timestamp timestamp"


def statuses(spark, rows):
    return spark.createDataFrame(rows, "job string, step string, status string, n int").selectExpr("job", "step", "status", "timestamp_seconds(1700000000 + n) as timestamp")


def alerts_of(rows, keys=("job", "step")):
    """By brute force, of all rows that don't come late."""
    found, last = [], {}
    for job, step, status, n in sorted(set(rows), key=lambda r: (r[3], r[2])):
        known = last.get((job, step))
        if status == "FAILURE" and known != "FAILURE" or status == "RESOLVED" and known == "FAILURE":
            found.append((job, step, n, status, known))
        last[job, step] = status
    return sorted(found, key=str)


def run_alerts(spark, base, outputs):
    """One run of the stream; what each batch gave is kept by its number."""

    def keep(rows, number):
        outputs[number] = sorted(((r.job, r.step, int(r.timestamp.timestamp()) - 1700000000, r.status, r.known) for r in rows.collect()), key=str)

    stream = spark.readStream.schema(STATUSES).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    found = alerts.alert_stream(stream, ["job", "step"])
    found.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start().awaitTermination()


def test_keyed_alerts_across_batches_restarts_and_replays(spark, tmp_path):
    base, outputs = str(tmp_path), {}
    hot = [("j", "hot", ["FAILURE", "FAILURE", "RESOLVED", "STARTED"][i % 4], i) for i in range(90)]
    first = [*hot[:45], ("j", None, "FAILURE", 1), ("k", "s", "STARTED", 5), ("k", "s", "FAILURE", 5), ("k", "s", "FAILURE", 5), ("k", "t", "RESOLVED", 5)]
    statuses(spark, first).coalesce(1).write.mode("append").parquet(f"{base}/in")
    run_alerts(spark, base, outputs)
    assert outputs[0] == alerts_of(first) and ("k", "s", 5, "FAILURE", None) in outputs[0]
    second = [*hot[45:], ("j", None, "RESOLVED", 9)]
    late = [("j", "hot", "FAILURE", 3), ("k", "s", "FAILURE", 4), ("k", "s", "RESOLVED", 2)]  # older than what is known: no alert, no new state
    statuses(spark, [*second, *late]).unionByName(spark.sql("SELECT 'k' AS job, 's' AS step, 'FAILURE' AS status, CAST(null AS timestamp) AS timestamp")).coalesce(1).write.mode("append").parquet(f"{base}/in")
    run_alerts(spark, base, outputs)
    assert sorted(outputs[0] + outputs[1], key=str) == alerts_of(first + second)
    third = [("k", "s", "FAILURE", 6), ("k", "s", "RESOLVED", 7), ("k", "t", "FAILURE", 8)]
    statuses(spark, third).coalesce(1).write.mode("append").parquet(f"{base}/in")
    run_alerts(spark, base, outputs)
    assert sorted(sum(outputs.values(), []), key=str) == alerts_of(first + second + third)
    before = outputs[2]
    for name in ("2", ".2.crc"):  # the last batch is done but not known to be: it is done again
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    again = {}
    run_alerts(spark, base, again)
    assert again[2] == before and before


def test_alerts_of_no_rows(spark, tmp_path):
    statuses(spark, []).write.parquet(f"{tmp_path}/in")
    outputs = {}
    run_alerts(spark, str(tmp_path), outputs)
    assert sum(outputs.values(), []) == []


def test_batch_log_holds_more_than_recent_progress(spark, tmp_path):
    base, held = str(tmp_path), spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    log = progress.BatchLog(spark, f"{base}/log")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    spark.streams.addListener(log)
    try:
        for i in range(6):
            spark.range(i + 1).coalesce(1).write.mode("append").parquet(f"{base}/in")
        for more in (0, 3):  # a second run of the same stream adds to its log
            for i in range(more):
                spark.range(10 + i).coalesce(1).write.mode("append").parquet(f"{base}/in")
            stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
            query = stream.writeStream.foreachBatch(lambda rows, number: rows.foreach(lambda r: None)).option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start()
            query.awaitTermination()
            log.wait(query)
            assert len(query.recentProgress) <= 2
    finally:
        spark.streams.removeListener(log)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", held)
    rows = [r for r in progress.batch_log(spark, f"{base}/log").collect() if r.rows]
    assert sorted((r.batch, r.rows) for r in rows) == list(enumerate([1, 2, 3, 4, 5, 6, 10, 11, 12]))
    assert len({r.stream for r in rows}) == 1 and all(r.seconds > 0 and r.started for r in rows)


def test_quarantine_is_taken_back_when_the_calendar_grows(spark, tmp_path):
    base, keys = str(tmp_path), ["flight_id", "time"]
    values = "SELECT timestamp'2025-12-30 10:00:00' AS time, '001' AS flight_id, {0}D AS altitude UNION ALL SELECT timestamp'2025-12-31 10:00:00', '001', {1}D UNION ALL SELECT null, '001', {2}D UNION ALL SELECT timestamp'2026-01-05 11:00:00', '001', {3}D"
    for n in (0, 10):  # the second batch corrects the first
        rows = spark.sql(values.format(n + 1, n + 2, n + 3, n + 4))
        rows.coalesce(1).write.mode("append").parquet(f"{base}/in")
        arrivals.load_arrivals(arrivals.arriving(spark, f"{base}/in", rows.schema), f"{base}/table", f"{base}/late", f"{base}/cp", "2026-01-01", "2026-12-31").awaitTermination()
    table = lambda: sorted(r.altitude for r in arrivals.settled(spark, f"{base}/table", rows.schema, keys).collect())
    refused = lambda first: sorted((r.batch, r.altitude) for r in arrivals.refused(spark, f"{base}/late", rows.schema, first, "2026-12-31").collect())
    assert table() == [14.0] and refused("2026-01-01") == [(0, 1.0), (0, 2.0), (0, 3.0), (1, 11.0), (1, 12.0), (1, 13.0)]
    steps = [("2026-01-01", "2025-12-31"), ("2026-01-01", "2025-12-31"), ("2025-12-31", "2025-12-01"), ("2025-12-01", "2025-12-01")]
    for (old, new), n, want in zip(steps, (2, 2, 2, 0), ([12.0, 14.0], [12.0, 14.0], [11.0, 12.0, 14.0], [11.0, 12.0, 14.0]), strict=True):
        assert arrivals.redrive(spark, f"{base}/late", f"{base}/table", rows.schema, (old, "2026-12-31"), (new, "2026-12-31")) == n
        assert table() == want
    assert refused("2025-12-01") == [(0, 3.0), (1, 13.0)]


def test_timed_trigger_polls_until_it_is_stopped(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.sql("SELECT timestamp'2026-01-05 10:00:00' AS time, '001' AS flight_id, 1.0D AS altitude")
    rows.coalesce(1).write.mode("append").parquet(f"{base}/in")
    query = arrivals.load_arrivals(arrivals.arriving(spark, f"{base}/in", rows.schema), f"{base}/table", f"{base}/late", f"{base}/cp", "2026-01-01", "2026-12-31", every="1 second")
    try:
        query.processAllAvailable()
        rows.withColumn("flight_id", F.lit("002")).coalesce(1).write.mode("append").parquet(f"{base}/in")
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert sorted(r.flight_id for r in arrivals.settled(spark, f"{base}/table", rows.schema, ["flight_id", "time"]).collect()) == ["001", "002"]


def test_keyed_alerts_of_many_keys_in_one_batch(spark, tmp_path):
    rows = [(f"j{i}", "s" if i % 3 else None, ["FAILURE", "RESOLVED", "STARTED"][(i + n * (i % 5)) % 3], n // 2) for i in range(3000) for n in range(8)]
    statuses(spark, rows).repartition(4).write.parquet(f"{tmp_path}/in")
    outputs = {}
    stream = spark.readStream.schema(STATUSES).parquet(f"{tmp_path}/in")
    keep = lambda batch, number: outputs.update({number: sorted(((r.job, r.step, int(r.timestamp.timestamp()) - 1700000000, r.status, r.known) for r in batch.collect()), key=str)})
    alerts.alert_stream(stream, ["job", "step"]).writeStream.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert list(outputs) == [0] and outputs[0] == alerts_of(rows)


def test_arriving_statuses_are_written_by_as_many_tasks_as_read_them(spark, tmp_path):
    """The query's input files grow with the table; before, two tasks wrote them all."""
    from wideskein.plans import queries as plans

    spark.sql("SELECT id AS event_id, timestamp'2024-01-03 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS ts, id % 7 AS user_id, 'error' AS event_type FROM range(900)").repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    made = plans.scratch
    try:
        plans.scratch = lambda spark, name: str(tmp_path / name)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert plans.queries()["alert_stream_keyed"](spark, str(tmp_path)).count() == 7
    finally:
        plans.scratch = made
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "alert-stream" / "in").glob("part-*"))) > 4
