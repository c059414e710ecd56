"""Golden numbers of the scalar expressions and edge cases of operators, on literal rows."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydrolake.functions import scalar as S
from hydrolake.operators import demand, features, lookups, pixels, ranges, series, skill, telemetry
from hydrolake.sources import readers


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_weir(spark):
    assert value(spark, S.weir_flow(F.lit(489.645), offset=0.0)) == pytest.approx(1.7266036024519353, rel=1e-9)
    assert value(spark, S.weir_flow(F.lit(489.645), offset=0.0) * 3600) == pytest.approx(6215.772968826967, rel=1e-9)
    assert value(spark, S.weir_flow(F.lit(489.0))) == 0


def test_evaporation(spark):
    day = F.lit("2025-05-10").cast("date")
    assert value(spark, S.evaporation_mm(day) * 302992.5428894 / 1000) == pytest.approx(1003.6135526348861, rel=1e-9)
    leap = F.lit("2025-02-10").cast("date")
    assert value(spark, S.evaporation_mm(leap, days_mode="leap2000") / S.evaporation_mm(leap)) == pytest.approx(28 / 29)


def test_iso_weeks(spark):
    days = [dt.date(2020, 12, 28) + dt.timedelta(i) for i in range(400)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select("d", S.iso_year("d"), S.iso_week("d"), S.weekday("d"), S.week_start(S.iso_year("d"), S.iso_week("d"))).collect()
    for d, y, w, k, m in rows:
        assert (y, w, k) == tuple(d.isocalendar()) and m == d - dt.timedelta(d.weekday())


def test_effective_rain_rejects_unknown_kinds(spark):
    assert value(spark, S.effective_rain(F.lit(10.0), F.lit("upland"))) == pytest.approx(4.25)
    with pytest.raises(Exception, match="unknown kind"):
        value(spark, S.effective_rain(F.lit(10.0), F.lit("lake")))


def test_buddhist_dates(spark):
    for text, want in (("25680229", None), ("25670229", dt.date(2024, 2, 29)), ("20240301", dt.date(2024, 3, 1)), ("2567", None), ("2567133x", None), (None, None)):
        assert value(spark, S.buddhist_date(F.lit(text).cast("string"))) == want


def test_floor_and_interpolation(spark):
    curve = spark.createDataFrame([("a", 1.0, 10.0), ("a", 2.0, 20.0), ("a", 4.0, 60.0), ("b", 0.0, 5.0)], "station string, level double, v double")
    df = spark.createDataFrame([("a", x) for x in (0.5, 1.0, 1.9999999999, 2.0, 3.0, 9.0)] + [("b", 7.0), ("c", 1.0), ("a", None)], "station string, level double")
    got = {(r.station, r.level): r.v for r in lookups.floor_lookup(df, curve, ["v"]).collect()}
    assert got == {("a", 0.5): 10, ("a", 1.0): 10, ("a", 1.9999999999): 20, ("a", 2.0): 20, ("a", 3.0): 20, ("a", 9.0): 60, ("b", 7.0): 5, ("c", 1.0): None, ("a", None): None}
    lines = {(r.station, r.level): r.v for r in lookups.interp_lookup(df, curve, "v").collect()}
    assert lines[("a", 0.5)] == 10 and lines[("a", 3.0)] == 40 and lines[("a", 9.0)] == 60 and lines[("b", 7.0)] == 5
    with pytest.raises(Exception, match="below the curve"):
        lookups.floor_lookup(df, curve, ["v"], strict=True).collect()


def test_nearest_ties_go_to_the_earlier_reading(spark):
    t = lambda s: dt.datetime.fromisoformat(f"2024-01-01 {s}")
    rows = [("a", t("09:50:00"), 1.0), ("a", t("10:10:00"), 2.0), ("a", t("10:30:00"), 3.0)]
    df = spark.createDataFrame(rows, "s string, ts timestamp, value double")
    got = {r.mark.hour: r.value for r in lookups.nearest_join(df, ["s"]).collect()}
    assert got == {10: 1.0, 11: 3.0}
    assert lookups.nearest_join(df.limit(0), ["s"]).count() == 0


def test_overlap_hours(spark):
    e = spark.createDataFrame([("2025-06-26 10:00:00", "2025-10-14 13:00:00")], "a string, b string").select(F.col("a").cast("timestamp_ntz").alias("start_ts"), F.col("b").cast("timestamp_ntz").alias("end_ts"))
    hours = [r.hours for r in lookups.interval_overlap(e, "2026-01-01").orderBy("day").collect()]
    assert hours[0] == 14 and hours[1] == 24 and hours[-1] == 13 and len(hours) == 111


def test_missing_rates_are_errors(spark):
    df, table = spark.createDataFrame([(1,), (9,)], "k int"), spark.createDataFrame([(1, 2.0)], "k int, v double")
    assert lookups.exact_lookup(df, table, ["k"], "v", "null").count() == 2
    with pytest.raises(Exception, match="no v"):
        lookups.exact_lookup(df, table, ["k"], "v").collect()


def test_recursion_carries_state_over_missing_rain(spark):
    df = spark.createDataFrame([("s", i, r) for i, r in enumerate([None, 10.0, None, 2.0, 0.0])], "s string, d int, r double")
    got = [x.api for x in series.recursive_api(df, ["s"], "d", "r").orderBy("d").collect()]
    assert got[0] is None and got[2] is None
    assert [got[1], got[3], got[4]] == pytest.approx([10.0, 11.5, 10.925])


def test_spi_policies(spark):
    df = spark.createDataFrame([("z", y, w, float(y * w % 7)) for y in (2000, 2001, 2002) for w in range(1, 10)], "zone string, iso_year int, iso_week int, rain double")
    zeros = series.spi4(df).where("iso_week < 4").select("spi4").distinct().collect()
    assert [r.spi4 for r in zeros] == [0.0]
    assert series.spi4(df, nan_policy="omit").where("iso_week < 4 AND spi4 <> 0").count() > 0


def test_conformal_quantile(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1, 20)] + [("b", 3.0)], "k string, s double")
    got = {r.k: r.q for r in skill.conformal_quantile(df, ["k"], "s").collect()}
    level = math.ceil(20 * 0.9) / 19
    assert got["a"] == pytest.approx(1 + level * 18) and got["b"] == 3.0


def test_time_warping(spark):
    def brute(a, b):
        d = [[math.inf] * 5 for _ in range(5)]
        d[0][0] = 0
        for i in range(4):
            for j in range(4):
                d[i + 1][j + 1] = abs(a[i] - b[j]) + min(d[i][j + 1], d[i + 1][j], d[i][j])
        return d[4][4]

    a, b = [1.0, 5.0, 2.0, 9.0], [2.0, 2.0, 8.0, 1.0]
    assert value(spark, pixels.dtw(F.array(*map(F.lit, a)), F.array(*map(F.lit, b)), 4, 4)) == brute(a, b)


def test_hurdle(spark):
    h = lambda p, q, d: value(spark, skill.hurdle(F.lit(p).cast("double"), 0.5, F.lit(q), F.lit(d).cast("double")))
    assert h(0.6, 5.0, 1.0) == 0 and h(0.4, 5.0, -9.0) == 0 and h(0.4, 5.0, 2.0) == 7 and h(None, 5.0, 2.0) is None and h(0.1, 5.0, None) is None
    assert skill.nearest_lag(6) == 4 and skill.nearest_lag(7) == 8 and skill.nearest_lag(10) == 8


def test_sources(spark, tmp_path):
    log = tmp_path / "log.csv"
    log.write_text("measure_datetime,RES1_water_level,RES1_rainfall_1h\n2024-1-2 3:4:5,489.5,\n,1,2\n2024-1-2 4:0:0,,x\n")
    wide = readers.read_wide_log(spark, str(log), ["measure_datetime", "RES1_water_level", "RES1_rainfall_1h"])
    long = {(r.data_type, r.measure_datetime.hour): r.value for r in readers.wide_to_long(wide).collect()}
    assert long == {("water_level", 3): 489.5, ("rainfall_1h", 4): None}
    curve = tmp_path / "curve.csv"
    curve.write_text("msl_height,z_factor,surface_area_m2,storage_m3\n2,1,20,200\n1,1,10,100\n")
    assert readers.read_curve(spark, str(curve)).count() == 2
    out = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    readers.write_idempotent(spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, v int"), out, "d")
    readers.write_idempotent(spark.createDataFrame([("2024-01-02", 9)], "d string, v int"), out, "d")
    assert sorted((str(r.d), r.v) for r in spark.read.parquet(out).collect()) == [("2024-01-01", 1), ("2024-01-02", 9)]
    readers.append_run_log(spark.createDataFrame([("A", 1)], "zone string, v int"), out + "-log", ["zone", "v"])
    readers.append_run_log(spark.createDataFrame([("A", 2)], "zone string, v int"), out + "-log", ["zone", "v"])
    assert spark.read.parquet(out + "-log").count() == 2


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing columns: b"):
        features.require(spark.createDataFrame([(1,)], "a int"), ["a", "b"])


def test_strict_spill_needs_24_hours(spark):
    df = spark.createDataFrame([("s", dt.date(2024, 1, 1), 490.0)] * 3, "station string, date date, level double")
    with pytest.raises(Exception, match="not 24 hours"):
        telemetry.spill_daily(df, ["station"], strict=True).collect()


def test_sql_functions(spark):
    names = S.register_all(spark)
    assert "hl_weir_flow" in names
    day, x = F.to_date(F.lit("2020-12-31")), [F.lit(v) for v in (300.0, 295.0, 1.5, -2.0, 1.5e7, -4e6)]
    twins = {
        "hl_iso_year(DATE '2020-12-31')": S.iso_year(day), "hl_iso_week(DATE '2020-12-31')": S.iso_week(day), "hl_season(20)": S.season(F.lit(20)),
        "hl_sine(5D, 52D)": S.cyclic(F.lit(5.0), 52)[0], "hl_cosine(5D, 52D)": S.cyclic(F.lit(5.0), 52)[1],
        "hl_et0(300D, 295D, 1.5D, -2D, 1.5e7D, -4e6D)": S.et0_penman_monteith(*x),
        "hl_db_ratio(-8D, -14D)": S.decibel_ratio(F.lit(-8.0), F.lit(-14.0))[0], "hl_linear_ratio(-8D, -14D)": S.decibel_ratio(F.lit(-8.0), F.lit(-14.0))[1],
        "hl_buddhist_date('25630229')": S.buddhist_date(F.lit("25630229")), "hl_buddhist_date('25640229')": S.buddhist_date(F.lit("25640229")),
        "hl_dtw(array(1D, 5D, 2D), array(2D, 8D, 1D, 1D))": pixels.dtw(F.array(*map(F.lit, (1.0, 5.0, 2.0))), F.array(*map(F.lit, (2.0, 8.0, 1.0, 1.0))), 3, 4),
    }
    for said, expression in twins.items():
        got = spark.range(1).select(F.expr(said).alias("a"), expression.alias("b")).first()
        assert got.a == (pytest.approx(got.b) if isinstance(got.b, float) else got.b), said
    row = spark.sql("SELECT hl_week_start(2024, 1) AS a, hl_season_code(20) AS b, hl_upland_rain(10D) AS c, hl_aridity(5D, 0D) AS d").first()
    assert (str(row.a), row.b, row.c, row.d) == ("2024-01-01", 2, 4.25, 10.0)


def test_crop_coefficients_by_week(spark):
    """The table of all crops and weeks: stage, coefficient, first and last week, number of weeks."""
    golden = """rice offseason 0.0 1 52 26, rice GS0 0.0 24 26 3, rice GS1 1.208 27 30 4, rice GS2 1.26 31 38 8, rice GS3 1.103 39 45 7, rice GS4 0.0 46 49 4,
        corn offseason 0.0 1 52 31, corn GS0 0.0 22 25 4, corn GS1 0.315 26 28 3, corn GS2 1.26 29 34 6, corn GS3 0.367 35 39 5, corn GS4 0.0 40 42 3,
        cassava GS4 1.05 1 7 7, cassava offseason 0.0 8 14 7, cassava GS0 0.0 15 17 3, cassava GS1 0.315 18 23 6, cassava GS2 0.84 24 36 13, cassava GS3 1.155 37 52 16,
        longan GS4 0.997 1 8 8, longan GS1 0.735 9 16 8, longan GS2 0.892 17 42 26, longan offseason 0.0 43 43 1, longan GS2_stress 0.0 44 50 7, longan GS3 0.945 51 52 2,
        rubber GS_defoliation 0.63 1 8 8, rubber GS_leaf_flush 0.84 9 16 8, rubber GS_mature 1.05 17 52 36"""
    want = sorted((c, s, float(k), int(a), int(b), int(n)) for c, s, k, a, b, n in (x.split() for x in golden.split(",")))
    table = demand.kc_week_table(spark)
    got = demand.stage_summary(table).select("crop", "stage", "kc", "first_week", "last_week", "n_weeks").collect()
    assert sorted(map(tuple, got)) == want and table.count() == 260


def test_running_values_of_a_hot_key(spark):
    """Two thirds of the rows have one key; ties in the order; nulls; against plain loops."""
    rng = random.Random(3)
    rows = [("hot" if i % 3 else rng.choice("abc"), rng.randrange(400), i, rng.choice([None, rng.random()])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, o long, i long, v double")
    got = {r.i: r for r in ranges.running_before(df.withColumn("w", F.col("v")), ["k"], "o", {"v": "sum", "w": "max"}, ties=["i"]).collect()}
    total, most = {}, {}
    for k, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        assert got[i].v_before == pytest.approx(total.get(k, 0)) and got[i].w_before == most.get(k)
        if v is not None:
            total[k], most[k] = total.get(k, 0) + v, max(most.get(k, v), v)
    for by in (["k"], []):
        numbers = ranges.numbered(df, by, "o", "n", ["i"]).collect()
        for key in {tuple(r[c] for c in by) for r in numbers}:
            own = sorted((r for r in numbers if tuple(r[c] for c in by) == key), key=lambda r: (r.o, r.i))
            assert [r.n for r in own] == list(range(1, len(own) + 1))
    for by in (["k"], []):
        found = {tuple(r[c] for c in by): (r.q, r.n) for r in ranges.exact_quantile(df, by, "v", F.lit(0.3)).collect()}
        for key, (q, n) in found.items():
            own = [r[3] for r in rows if r[3] is not None and (not by or r[0] == key[0])]
            assert n == len(own) and q == pytest.approx(np.quantile(own, 0.3))
    assert ranges.numbered(df.limit(0), ["k"], "o", "n").count() == 0
