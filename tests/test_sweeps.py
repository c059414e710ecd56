"""Sweeps and scans over ranges against plain loops, with hot keys, ties, open ends and nulls."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hydrolake.operators import lookups, ranges, series, telemetry

START = dt.datetime(2024, 1, 1)


def test_intervals_are_swept(spark):
    rng = random.Random(2)
    days = [(s, START + dt.timedelta(days=d, hours=7)) for s, n in (("hot", 300), ("b", 20), ("none", 5)) for d in range(n) if d % 7 != 3]
    events = []
    for k in range(900):
        a = START + dt.timedelta(hours=rng.randrange(-48, 7000))
        b = rng.choice([None, a, a + dt.timedelta(hours=rng.randrange(1, 400)), a - dt.timedelta(hours=3)])
        events.append(("hot" if k % 9 else "b", a, b, float(rng.randrange(100)), k))
    events += [("b", START + dt.timedelta(hours=7), START + dt.timedelta(hours=7), 5.0, 9001), ("other", START, None, 1.0, 9002)]
    d = spark.createDataFrame(days, "s string, ref_ts timestamp_ntz")
    e = spark.createDataFrame(events, "s string, start_ts timestamp_ntz, end_ts timestamp_ntz, rate double, no long")
    got = {(r.s, r.ref_ts): (round(r.total, 6), r.n_open, list(r.opened), list(r.closed)) for r in lookups.sweep_intervals(d, e, ["s"], "rate", "no").collect()}
    before: dict = {}
    for s, at in days:
        covers = {no for key, a, b, _, no in events if key == s and a <= at and (b is None or at <= b)}
        old = before.get(s, set())
        assert got[s, at] == (round(sum(r for _, _, _, r, no in events if no in covers), 6), len(covers), sorted(covers - old), sorted(old - covers))
        before[s] = covers
    assert len(got) == len(days) and lookups.sweep_intervals(d, e.limit(0), ["s"], "rate", "no").where("n_open <> 0").isEmpty()
    pairs = lookups.point_in_interval(d, e, ["s"]).groupBy("s", "ref_ts").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {(r.s, r.ref_ts): r.n for r in pairs} == {k: v[1] for k, v in got.items() if v[1]}


def test_sweep_makes_no_pairs(spark):
    d = spark.range(200).selectExpr("'a' AS s", "timestamp_ntz '2024-01-01 07:00:00' + make_dt_interval(CAST(id AS INT)) AS ref_ts")
    e = spark.range(3000).selectExpr("'a' AS s", "timestamp_ntz '2024-01-01 00:00:00' AS start_ts", "CAST(NULL AS timestamp_ntz) AS end_ts", "1.0D AS rate", "id AS no")
    rows = lookups.sweep_intervals(d, e, ["s"], "rate", "no").orderBy("ref_ts").collect()
    assert [len(r.opened) for r in rows] == [3000] + [0] * 199 and {r.total for r in rows} == {3000.0}


def test_recursive_index_is_a_scan(spark):
    rng = random.Random(6)
    rows = [(s, dt.date(1990, 1, 1) + dt.timedelta(days=d), rng.choice([None, 0.0, rng.random() * 30])) for s, n in (("hot", 3000), ("b", 40), ("c", 1)) for d in range(n)]
    rows += [("dry", dt.date(1990, 1, d), None) for d in (1, 2)]
    df = spark.createDataFrame(rows, "s string, d date, r double").repartition(5)
    got = {(x.s, x.d): x.api for x in series.recursive_api(df, ["s"], "d", "r", 0.9).collect()}
    state: dict = {}
    for s, d, r in rows:
        if r is None:
            assert got[s, d] is None
        else:
            state[s] = 0.9 * state.get(s, 0.0) + r
            assert abs(got[s, d] - state[s]) < 1e-9
    assert len(got) == len(rows) and series.recursive_api(df.limit(0), ["s"], "d", "r").count() == 0


def test_gaps_are_filled_or_their_days_left_out(spark):
    """Rain in a one-hour gap and a three-hour gap leave out their days; a dry hour is interpolated; open ends are long."""
    level = {h: 10.0 + h for h in range(24 * 6)}
    rain = {30: 4.0, 77: 9.0}
    for h in (5, 6, 30, 54, 55, 56, 78, 100, 143):  # dry two hours, wet hour, three hours, hour after rain, dry hour, open end
        del level[h]
    rows = [("a", START + dt.timedelta(hours=h), level.get(h), rain.get(h)) for h in range(24 * 6)] + [("b", START, None, None)]
    df = spark.createDataFrame(rows, "s string, hour timestamp_ntz, level double, rain double")
    got = {(r.s, r.hour): r for r in telemetry.fill_or_flag_gap(df, ["s"], "hour", "level", rain="rain").collect()}
    for s, at, v, _ in rows:
        h = (at - START) // dt.timedelta(hours=1)
        r = got[s, at]
        out = s == "b" or h // 24 in (1, 2, 3, 5)
        assert r.data_gap_day == out and r.gap_status == ("data_gap_day" if out else "ok" if v is not None else "interpolated")
        assert r.interpolated == (not out and v is None) and (r.filled is None if out else abs(r.filled - (10.0 + h)) < 1e-9)
    dry = {(r.s, r.hour): r.gap_status for r in telemetry.fill_or_flag_gap(df, ["s"], "hour", "level").collect()}
    assert dry["a", START + dt.timedelta(hours=30)] == "interpolated" and dry["a", START + dt.timedelta(hours=78)] == "interpolated"


@pytest.mark.parametrize("kind", ["double", "bigint", "timestamp", "date", "timestamp_ntz"])
def test_ranges_grow_in_number_with_their_key(spark, kind):
    """Sums and maxima before each row are those of a window, however finely a key is cut; ties and one long tail too."""
    at = {
        "double": "pow(id % 997, 3) / 7e0", "bigint": "id % 701 - 300", "timestamp": "timestamp_seconds(id % 997 * 1000)", "date": "date_add(DATE'2020-01-01', CAST(id % 500 AS INT))",
        "timestamp_ntz": "CAST(timestamp_seconds(id % 997 * 40000) AS timestamp_ntz)",
    }[kind]
    rows = spark.range(3000).selectExpr("id", "id % 10 < 9 AS hot", f"{at} AS at", "id * 37 % 101 AS v").cache()
    coarse, fine = (ranges.parted(rows, ["hot"], "at", 4, n) for n in (1000, 20))
    assert coarse.groupBy("hot").agg(F.max("_part").alias("p")).agg(F.max("p")).first()[0] == 3
    sizes = [r["count"] for r in fine.groupBy("hot", "_part").count().collect()]
    assert len(sizes) > 40 and sum(sizes) == 3000
    ends = fine.groupBy("hot", "_part").agg(F.min("at").alias("a"), F.max("at").alias("b"))
    in_order = Window.partitionBy("hot").orderBy("_part")
    assert ends.withColumn("_next", F.lead("a").over(in_order)).where("_next <= b").isEmpty()
    before = Window.partitionBy("hot").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = {r.id: (r.s, r.m) for r in rows.select("id", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("s"), F.max("v").over(before).alias("m")).collect()}
    got = ranges.running_before(rows.withColumn("w", F.col("v")), ["hot"], "at", {"v": "sum", "w": "max"}, 4, ["id"], 20)
    assert {r.id: (r.v_before, r.w_before) for r in got.collect()} == want
    rows.unpersist()


def test_rows_without_order_or_number(spark):
    rows = spark.sql("SELECT CAST(col1 AS double) AS at, 1L AS v FROM VALUES (NULL), (NULL), ('NaN'), ('NaN'), ('Infinity'), ('-Infinity'), ('1'), ('2'), ('2'), ('3')")
    got = ranges.running_before(rows.withColumn("k", F.lit(1)), ["k"], "at", {"v": "sum"}, 2, (), 1)
    assert sorted(r.v_before for r in got.collect()) == list(range(10))
    assert ranges.running_before(rows.limit(0), [], "at", {"v": "sum"}).count() == 0
