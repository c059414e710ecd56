"""Streams: state that ends, order within a key, replays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hydrolake.operators import lookups, series, telemetry
from hydrolake.sources.shared import fresh_path
from hydrolake.streaming import streams

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def readings(spark):
    """Ten files of four days each: two stations, a reading every 20 minutes or so, some without a value."""
    rng, rows, at = random.Random(5), [], START
    while at < START + dt.timedelta(days=40):
        at += dt.timedelta(minutes=rng.randrange(5, 35), seconds=rng.randrange(60))
        for station in ("A", "B"):
            rows.append((station, at + dt.timedelta(seconds=rng.randrange(60)), None if rng.random() < 0.05 else round(rng.random() * 10, 2)))
    folder = fresh_path(spark, "readings")
    schema = "station string, ts timestamp, value double"
    for k in range(10):
        own = [r for r in rows if (r[1] - START).days // 4 == k or k == 9 and (r[1] - START).days >= 40]
        spark.createDataFrame(own, schema).coalesce(1).write.parquet(f"{folder}/part={k}")
    return spark.createDataFrame(rows, schema).cache(), folder


def source(spark, folder):
    return spark.readStream.schema("station string, ts timestamp, value double").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


def run(spark, make, folder):
    """The stream's table and the rows of state after each batch that read a file."""
    clock, out = streams.clock_folder(spark, fresh_path(spark, "clock")), fresh_path(spark, "out")
    stream = make(source(spark, folder), clock)
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", f"{out}/out")
    progress = streams.run_through(writer, spark, out, clock=clock)
    held = [[s["numRowsTotal"] for s in p["stateOperators"]] for p in progress if p["numInputRows"] > 1]
    return spark.read.schema(stream.schema).parquet(f"{out}/out"), [sum(h) for h in held]


def rows_of(df, digits=6):
    return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_hours_leave_the_state(spark, readings):
    rows, folder = readings
    out, held = run(spark, lambda x, clock: streams.stream_hourly(x, ["station"], "ts", "value", clock=clock), folder)
    want = rows.groupBy("station", F.date_trunc("hour", "ts").alias("hour")).agg(F.max_by("value", "ts").alias("last"), F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))
    assert rows_of(out.withColumns({"last": F.coalesce("last", F.lit(-1)), "mean": F.coalesce("mean", F.lit(-1))})) == rows_of(want.withColumns({"last": F.coalesce("last", F.lit(-1)), "mean": F.coalesce("mean", F.lit(-1))}))
    assert len(held) >= 10 and max(held[2:]) <= 1.2 * max(held[:2]) < want.count() / 3


def test_days_leave_the_state(spark, readings):
    rows, folder = readings
    out, held = run(spark, lambda x, clock: streams.stream_daily_rain(x, ["station"], "ts", "value", clock=clock), folder)
    marks = lookups.nearest_join(rows, ["station"]).withColumn("level", F.lit(1.0))
    want = telemetry.daily_telemetry(marks.withColumnRenamed("value", "rain"), ["station"]).select("station", "date", "rain_24h_mm", "hours_covered")
    assert rows_of(out) == rows_of(want)
    assert len(held) >= 10 and max(held[2:]) <= 1.2 * max(held[:2])


def test_sliding_weeks_leave_the_state(spark, readings):
    rows, folder = readings
    daily = lambda x: x.select("station", F.to_date("ts").alias("date"), F.coalesce("value", F.lit(0.0)).alias("precipitation"))
    out, held = run(spark, lambda x, clock: streams.stream_rolling_rain(daily(x), ["station"], delay="1 day", clock=clock), folder)
    each = daily(rows).withColumn("last_day", F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda k: F.date_add("date", k))))
    want = each.groupBy("station", "last_day").agg(F.sum("precipitation").alias("rain"), F.count(F.lit(1)).alias("n_days"))
    assert rows_of(out) == rows_of(want)
    assert len(held) >= 10 and max(held[3:]) <= 1.2 * max(held[:3])


def test_latest_has_a_state_row_per_key(spark, readings):
    rows, folder = readings
    numbered = lambda x: x.withColumn("row_id", F.unix_micros("ts"))
    stream = streams.stream_latest(numbered(source(spark, folder)), ["station"], "row_id", "ts", "value")
    out = streams.run_upserts(stream, fresh_path(spark, "latest"), ["station"], "row_id")
    want = numbered(rows).where("value IS NOT NULL").groupBy("station").agg(F.max_by("value", "row_id").alias("value"), F.max_by("ts", "row_id"), F.max("row_id"))
    assert rows_of(out) == rows_of(want) and out.count() == 2


@pytest.fixture
def small_frames(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "50")
    yield
    spark.conf.set(name, before)


def arrivals(spark, folder, n=1200):
    """Arrival numbers in no order within a file, in several files; a third of the times late or equal."""
    rng, rows, at = random.Random(3), [], START
    for k in range(n):
        at += dt.timedelta(minutes=rng.choice([5, 20, 50, 70, 0]))
        rows.append(("AB"[k % 3 == 0], k, at - dt.timedelta(hours=rng.choice([0, 0, 0, 1, 30]))))
    for part in range(3):
        own = rows[part * n // 3 : (part + 1) * n // 3]
        rng.shuffle(own)
        spark.createDataFrame(own, "station string, row_id long, ts timestamp").repartition(3).sortWithinPartitions(F.rand(1)).coalesce(1).write.parquet(f"{folder}/part={part}")
    return spark.createDataFrame(rows, "station string, row_id long, ts timestamp")


def test_readings_are_accepted_in_arrival_order(spark, small_frames):
    folder = fresh_path(spark, "arrivals")
    rows = arrivals(spark, folder)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)
    gaps = streams.stream_monotonic_gap(stream, "station", "row_id", "ts", width=64)
    history, anomalies = streams.run_split(gaps, fresh_path(spark, "mono"), "NOT stored OR gap_flag")
    want = telemetry.accept_monotonic(rows, ["station"], "row_id", "ts").selectExpr("station", "row_id", "stored", "coalesce(gap_hours, -1)", "gap_flag")
    got = history.unionByName(anomalies).selectExpr("key", "row_id", "stored", "coalesce(gap_hours, -1)", "gap_flag")
    assert rows_of(got) == rows_of(want)
    assert history.where("NOT stored OR gap_flag").isEmpty() and not anomalies.where("NOT stored").isEmpty() and not anomalies.where("gap_flag").isEmpty()


def test_valves_are_paired_in_arrival_order(spark, small_frames):
    rng, folder = random.Random(8), fresh_path(spark, "forms")
    forms = [("AB"[k % 4 == 0], k, *rng.choice([("open", None), ("close", rng.randrange(1, 200)), ("close", None)])) for k in range(900)]
    schema = "station string, row_id long, kind string, event_no long"
    for part in range(3):
        own = forms[part * 300 : (part + 1) * 300]
        rng.shuffle(own)
        spark.createDataFrame(own, schema).coalesce(1).write.parquet(f"{folder}/part={part}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)
    got = streams.run_to_table(streams.stream_valve_pairing(stream, "station", "row_id", width=64), fresh_path(spark, "pairs"), keyed=True)
    want, count, open_ = [], {"A": 0, "B": 0}, {"A": set(), "B": set()}
    for station, row, kind, no in forms:
        if kind == "open":
            count[station] += 1
            open_[station].add(count[station])
            want.append((station, row, count[station], "opened"))
        else:
            want.append((station, row, -1 if no is None else no, "closed" if no in open_[station] else "rejected"))
            open_[station].discard(no)
    assert rows_of(got) == sorted(want)


def written(spark, path):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def test_upserts_write_what_they_touch(spark):
    schema = "k long, v string, at long"
    table = streams.UpsertTable(fresh_path(spark, "upsert"), ["k"], "at", partitions=32)
    table.write(spark.createDataFrame([(k, f"{hash((k, 1))}", 0) for k in range(20_000)], schema), 0)
    whole = written(spark, f"{table.path}/rows")
    table.write(spark.createDataFrame([(7, "new", 1), (7, "newer", 2), (30_000, "added", 1), (8, "stale", -1)], schema), 1)
    assert written(spark, f"{table.path}/rows") - whole < whole / 5
    rows = {r.k: r.v for r in table.read(spark, schema).collect()}
    assert len(rows) == 20_001 and rows[7] == "newer" and rows[30_000] == "added" and rows[8] != "stale"
    before = written(spark, table.path), rows_of(table.read(spark, schema))
    for number in (0, 1):  # replays
        table.write(spark.createDataFrame([(7, "again", 9)], schema), number)
    assert before == (written(spark, table.path), rows_of(table.read(spark, schema)))
    # a batch that failed before it was logged is written over
    spark.createDataFrame([(1, "half", 9)], schema).withColumn("_part", F.lit(0)).write.partitionBy("_part").parquet(f"{table.path}/rows/2")
    assert rows_of(table.read(spark, schema)) == before[1]
    table.write(spark.createDataFrame([(1, "whole", 9)], schema), 2)
    assert {r.v for r in table.read(spark, schema).where("k = 1").collect()} == {"whole"}
    table.write(spark.createDataFrame([], schema), 3)
    assert table.read(spark, schema).count() == 20_001
    before = rows_of(table.read(spark, schema))
    size = written(spark, f"{table.path}/rows")
    table.vacuum(spark, keep=1)
    assert rows_of(table.read(spark, schema)) == before and written(spark, f"{table.path}/rows") < size
    assert table.logged(spark) == [2]
    table.write(spark.createDataFrame([(7, "late", 99)], schema), 2)
    assert rows_of(table.read(spark, schema)) == before


def test_dedup_of_upserts_keeps_the_schema(spark):
    df = spark.createDataFrame([(1, "a", 1)], "k long, v string, at long")
    assert series.dedup_latest(df, ["k"], "at").columns == ["k", "v", "at"]


def test_streams_without_rows(spark):
    folder = fresh_path(spark, "nothing")
    spark.createDataFrame([], "station string, row_id long, ts timestamp, value double, kind string, event_no long, date date, precipitation double").write.parquet(folder)
    rows = lambda: streams.stream_ingest(spark, folder)
    path = lambda: fresh_path(spark, "empty")
    clock = streams.clock_folder(spark, path())
    assert streams.run_to_table(streams.stream_hourly(rows(), ["station"], "ts", "value", clock=clock), path(), clock=clock).count() == 0
    history, anomalies = streams.run_split(streams.stream_monotonic_gap(rows(), "station", "row_id", "ts"), path(), "NOT stored OR gap_flag")
    assert history.count() == 0 and anomalies.count() == 0
    assert streams.run_to_table(streams.stream_valve_pairing(rows(), "station", "row_id"), path(), keyed=True).count() == 0
    assert streams.run_upserts(streams.stream_latest(rows(), ["station"], "row_id", "ts", "value"), path(), ["station"], "row_id").count() == 0
