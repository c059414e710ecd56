"""Queries: crop-water demand, parcels, weekly features, run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake.functions import scalar as S
from hydrolake.operators import demand, features, lookups, series
from hydrolake.plans.climate import CLIMATE, RV, climate, weekly_rain
from hydrolake.plans.helpers import WEEKLY, dt, rd, sql, tidy
from hydrolake.plans.registry import register
from hydrolake.sources import readers
from hydrolake.sources.shared import fresh_path
from hydrolake.sources.views import view

K = "zone, iso_year, iso_week"
RVH, HOLEY = "rain_daily rain_holes weather_daily", WEEKLY.replace("FROM rain_daily", "FROM rain_holes")
KEYS = ["zone", "iso_year", "iso_week"]
DV = RV + " crop_area"
_STAGES = ", ".join(f"({i}, '{c}', '{s}', {a}, {b}, {demand.raised(k)}e0)" for i, (c, s, a, b, k) in enumerate(demand.STAGES))
KCW = f"""st(pos, crop, stage, a, b, base) AS (VALUES {_STAGES})
, wk AS (SELECT crop, CAST(w AS INT) AS week FROM (SELECT DISTINCT crop FROM st) CROSS JOIN range(1, 53) t(w))
, hit AS (SELECT crop, week, arg_min(stage, pos) AS stage, arg_min(base, pos) AS base FROM wk JOIN st USING (crop) WHERE CASE WHEN a <= b THEN week BETWEEN a AND b ELSE week >= a OR week <= b END GROUP BY 1, 2)
, kcw AS (SELECT wk.crop, wk.week, coalesce(stage, 'offseason') AS stage, coalesce(base, 0e0) AS kc FROM wk LEFT JOIN hit USING (crop, week))"""
KC = ", " + KCW + ", kc AS (SELECT crop, week, kc FROM kcw)"
DEMAND = KC + """
, dx AS (SELECT c.*, a.crop, a.area_m2, k.kc FROM clim c JOIN (SELECT * FROM crop_area WHERE crop <> 'etc') a USING (zone) LEFT JOIN kc k ON k.crop = a.crop AND k.week = least(c.iso_week, 52))
, dem AS (SELECT zone, iso_year, iso_week, coalesce(sum(greatest(0e0, kc * et0 - p_eff) * area_m2 / 1000) FILTER (WHERE kc IS NOT NULL), 0e0) AS net_m3, coalesce(sum(kc * et0 * area_m2 / 1000), 0e0) AS etc_m3, count(*) FILTER (WHERE kc IS NULL) AS crops_without_kc FROM dx GROUP BY 1, 2, 3)"""


def weekly_demand(spark, sf_dir):
    return demand.crop_demand(climate(spark, sf_dir), demand.kc_week_table(spark), view(spark, sf_dir, "crop_area"))


@register("a11_crop_demand", sql(DV, WEEKLY + CLIMATE + DEMAND + f"SELECT {K}, {rd('net_m3', 'net_m3', 3)}, {rd('etc_m3', 'etc_m3', 3)}, crops_without_kc, {rd("net_m3 / CASE WHEN zone = 'A' THEN 0.9e0 ELSE 1e0 END", 'gross_m3', 3)} FROM dem"))
def a11_crop_demand(spark, sf_dir):
    return tidy(weekly_demand(spark, sf_dir), 3)


SUB = """, sub AS (SELECT zone, iso_year, iso_week, CASE WHEN crop IN ('rice', 'corn') THEN 'north' ELSE 'south' END AS sub_area, coalesce(sum(greatest(0e0, kc * et0 - p_eff) * area_m2 / 1000) FILTER (WHERE kc IS NOT NULL), 0e0) AS d FROM dx GROUP BY 1, 2, 3, 4)
, sh AS (SELECT *, CASE WHEN t > 0 THEN round(d / t, 6) END AS share FROM (SELECT *, sum(d) OVER (PARTITION BY zone, iso_year, iso_week) AS t FROM sub))"""


def shares(spark, sf_dir):
    area = view(spark, sf_dir, "crop_area").withColumn("sub_area", F.when(F.col("crop").isin("rice", "corn"), "north").otherwise("south"))
    by_area = demand.crop_demand(climate(spark, sf_dir), demand.kc_week_table(spark), area, by=("zone", "sub_area"))
    return demand.demand_share(by_area, KEYS, "net_m3")


@register("a12_demand_share", sql(DV, WEEKLY + CLIMATE + DEMAND + SUB + f"SELECT {K}, sub_area, {rd('share', 'share', 6)} FROM sh"))
def a12_demand_share(spark, sf_dir):
    return tidy(shares(spark, sf_dir).select(*KEYS, "sub_area", "share"), 6)


@register("a13_allocate", sql(DV, WEEKLY + CLIMATE + DEMAND + SUB + f"SELECT {K}, sub_area, {rd('share * rain * 100', 'allocated', 2)} FROM sh JOIN (SELECT zone, iso_year, iso_week, rain FROM clim) USING (zone, iso_year, iso_week)"))
def a13_allocate(spark, sf_dir):
    forecast = climate(spark, sf_dir).select(*KEYS, (F.col("rain") * 100).alias("forecast"))
    return tidy(demand.allocate(forecast, shares(spark, sf_dir), KEYS, "forecast").select(*KEYS, "sub_area", "allocated"), 2)


@register("j7_kc_join", sql(DV, WEEKLY + CLIMATE + KC + f" SELECT {K}, crop, {rd('coalesce(kc, 0)', 'kc')} FROM (SELECT c.zone, c.iso_year, c.iso_week, a.crop FROM clim c JOIN crop_area a USING (zone)) x LEFT JOIN kc ON kc.crop = x.crop AND kc.week = x.iso_week".replace("SELECT zone, iso_year, iso_week, crop", "SELECT x.zone AS zone, x.iso_year AS iso_year, x.iso_week AS iso_week, x.crop AS crop")))
def j7_kc_join(spark, sf_dir):
    x = climate(spark, sf_dir).select(*KEYS).join(view(spark, sf_dir, "crop_area").select("zone", "crop"), "zone").withColumn("week", F.col("iso_week"))
    return tidy(demand.kc_join(x, demand.kc_week_table(spark)).select(*KEYS, "crop", "kc"))


@register("a19_pivot_table", sql(DV, WEEKLY + f"SELECT zone, iso_year, {', '.join(rd(f'sum(rain) FILTER (WHERE iso_week % 4 = {i})', f'w{i}') for i in range(4))} FROM wr GROUP BY 1, 2"))
def a19_pivot_table(spark, sf_dir):
    x = weekly_rain(spark, sf_dir).withColumn("w", F.concat(F.lit("w"), (F.col("iso_week") % 4).cast("string")))
    return tidy(demand.pivot(x, ["zone", "iso_year"], "w", ["w0", "w1", "w2", "w3"], F.sum("rain")))


@register("g3_kc_week_table", f"WITH {KCW} SELECT n.zone, CAST(n.year AS INT) AS year, k.crop, k.stage, {rd('k.kc', 'kc', 3)}, n.n FROM (SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'B' END AS zone, isoyear(l_shipdate) AS year, CAST(least(week(l_shipdate), 52) AS INT) AS week, count(*) AS n FROM lineitem GROUP BY 1, 2, 3) n JOIN kcw k ON k.week = n.week")
def g3_kc_week_table(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.when(F.col("l_suppkey") % 2 == 0, "A").otherwise("B").alias("zone"), S.iso_year("l_shipdate").alias("year"), S.clamp_week(S.iso_week("l_shipdate")).alias("week"))
    n = li.groupBy("zone", "year", "week").agg(F.count(F.lit(1)).alias("n"))
    return tidy(n.join(demand.kc_week_table(spark), "week").select("zone", "year", "crop", "stage", "kc", "n"), 3)


PARC = """, g AS (SELECT *, harvest - plant AS days FROM (SELECT *, try_cast(concat_ws('-', CAST(CAST(plant_text[1:4] AS INT) - 543 AS VARCHAR), plant_text[5:6], plant_text[7:8]) AS DATE) AS plant, try_cast(concat_ws('-', harvest_text[1:4], harvest_text[5:6], harvest_text[7:8]) AS DATE) AS harvest FROM parcels))"""


@register("p11_be_date", sql("parcels", PARC + f"SELECT parcel_id, {dt('plant', 'plant')}, {dt('harvest', 'harvest')}, CAST(days AS INT) AS days FROM g"))
def p11_be_date(spark, sf_dir):
    return tidy(demand.growing(view(spark, sf_dir, "parcels")).select("parcel_id", "plant", "harvest", "days"))


@register("p15_bbox_filter", sql("parcels", "SELECT parcel_id FROM parcels WHERE lat BETWEEN 18.25 AND 18.75 AND lon BETWEEN 99.1 AND 99.6"))
def p15_bbox_filter(spark, sf_dir):
    return view(spark, sf_dir, "parcels").where(F.col("lat").between(18.25, 18.75) & F.col("lon").between(99.1, 99.6)).select("parcel_id")


@register("p16_recode", sql("parcels", "SELECT CASE crop WHEN 'rice' THEN 'RC' WHEN 'corn' THEN 'CN' WHEN 'cassava' THEN 'CS' ELSE 'etc' END AS code, count(*) AS n FROM parcels GROUP BY 1"))
def p16_recode(spark, sf_dir):
    codes = F.create_map(*[F.lit(x) for kv in {"rice": "RC", "corn": "CN", "cassava": "CS"}.items() for x in kv])
    return view(spark, sf_dir, "parcels").select(F.coalesce(F.try_element_at(codes, F.col("crop")), F.lit("etc")).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@register("a16_phenology_calendar", sql("parcels", PARC + f"SELECT crop, CAST(year(plant) AS INT) AS year, {rd('avg(dayofyear(plant)) + 1e-9', 'plant_doy', 1)}, {rd('stddev_samp(dayofyear(plant)) + 1e-9', 'plant_doy_std', 1)}, {rd('avg(dayofyear(harvest)) + 1e-9', 'harvest_doy', 1)}, {rd('avg(days) + 1e-9', 'days', 1)}, count(*) AS n, {rd('sum(area_rai)', 'area_rai', 1)} FROM g WHERE days > 30 AND days < 365 GROUP BY 1, 2"))
def a16_phenology_calendar(spark, sf_dir):
    x = view(spark, sf_dir, "parcels").withColumn("year", F.year(S.buddhist_date("plant_text")))
    return tidy(demand.phenology(x, ["crop", "year"]), 1)


@register("a17_crop_totals", sql("parcels", PARC + f"SELECT crop, CAST(year(plant) AS INT) AS year, count(*) AS n, {rd('sum(area_rai * 1600)', 'area_m2', 1)} FROM g GROUP BY 1, 2 UNION ALL SELECT crop, NULL, count(*), {rd('sum(area_rai * 1600)', 'area_m2', 1)} FROM g GROUP BY 1"))
def a17_crop_totals(spark, sf_dir):
    return tidy(demand.crop_totals(view(spark, sf_dir, "parcels")), 1)


# weekly features -------------------------------------------------------------------------------------------------
SPARSE = ", sw AS (SELECT zone, iso_year, iso_week, rain, CAST(date_trunc('week', make_date(iso_year, 1, 4)) AS DATE) + 7 * (iso_week - 1) AS week_start FROM wr WHERE n_days >= 6)"


def sparse_weeks(spark, sf_dir):
    """Weeks with some missing, so rows and calendar weeks differ."""
    return series.weekly_rain(view(spark, sf_dir, "rain_holes")).where("n_days >= 6").select(*KEYS, "rain", S.week_start("iso_year", "iso_week").alias("week_start"))


@register("w1_row_lags", sql(RVH, HOLEY + SPARSE + f"SELECT {K}, {', '.join(rd(f'lag(rain, {k}) OVER w', f'rain_lag{k}') for k in (1, 2, 4, 12))} FROM sw WINDOW w AS (PARTITION BY zone ORDER BY iso_year, iso_week)"))
def w1_row_lags(spark, sf_dir):
    return tidy(series.row_lags(sparse_weeks(spark, sf_dir), ["zone"], ["iso_year", "iso_week"], "rain", (1, 2, 4, 12)).drop("rain", "week_start"))


@register("w2_rolling_prev", sql(RVH, HOLEY + SPARSE + f"SELECT {K}, " + ", ".join(f"{rd(f'CASE WHEN count(rain) OVER w{n} = {n} THEN avg(rain) OVER w{n} END', f'rain_mean{n}')}, {rd(f'CASE WHEN count(rain) OVER w{n} = {n} THEN stddev_samp(rain) OVER w{n} END', f'rain_std{n}')}" for n in (4, 8)) + " FROM sw WINDOW w4 AS (PARTITION BY zone ORDER BY iso_year, iso_week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), w8 AS (PARTITION BY zone ORDER BY iso_year, iso_week ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)"))
def w2_rolling_prev(spark, sf_dir):
    return tidy(series.rolling_prev(sparse_weeks(spark, sf_dir), ["zone"], ["iso_year", "iso_week"], "rain", (4, 8)).drop("rain", "week_start"))


@register("w4_calendar_roll", sql(RVH, HOLEY + SPARSE + f"SELECT a.zone, a.iso_year, a.iso_week, {rd('CASE WHEN count(b.rain) = 4 THEN avg(b.rain) END', 'rain_mean4')}, {rd('CASE WHEN count(b.rain) = 4 THEN stddev_samp(b.rain) END', 'rain_std4')} FROM sw a LEFT JOIN sw b ON a.zone = b.zone AND b.week_start < a.week_start AND b.week_start >= a.week_start - 28 GROUP BY 1, 2, 3"))
def w4_calendar_roll(spark, sf_dir):
    return tidy(series.calendar_roll(sparse_weeks(spark, sf_dir), ["zone"], "week_start", "rain", 4).drop("rain", "week_start"))


@register("w5_lead_targets", sql(RVH, HOLEY + SPARSE + f"SELECT {K}, {', '.join(rd(f'y{h}', f'y_h{h}') for h in range(1, 13))} FROM (SELECT *, {', '.join(f'lead(rain, {h}) OVER w AS y{h}' for h in range(1, 13))} FROM sw WINDOW w AS (PARTITION BY zone ORDER BY iso_year, iso_week)) WHERE y1 IS NOT NULL"))
def w5_lead_targets(spark, sf_dir):
    return tidy(series.lead_targets(sparse_weeks(spark, sf_dir), ["zone"], ["iso_year", "iso_week"], "rain", 12).drop("rain", "week_start"))


@register("j13_calendar_lag", sql(RVH, HOLEY + SPARSE + f"SELECT a.zone, a.iso_year, a.iso_week, {rd('b.rain', 'rain_lag4')} FROM sw a LEFT JOIN sw b ON a.zone = b.zone AND b.week_start = a.week_start - 28"))
def j13_calendar_lag(spark, sf_dir):
    return tidy(lookups.calendar_lag(sparse_weeks(spark, sf_dir), ["zone"], "week_start", "rain", 4).drop("rain", "week_start"))


@register("w15_sliding_windows", sql(RV, WEEKLY + f", sx AS (SELECT zone, iso_year, iso_week, CASE WHEN n_days >= 7 THEN round(rain, 2) END AS r FROM wr) SELECT {K}, coalesce(array_to_string(list_transform(x, lambda v: CAST(round(v * 100) AS BIGINT)), ','), '') AS win, x IS NULL AS no_data FROM (SELECT zone, iso_year, iso_week, count(*) OVER w AS n, CASE WHEN count(r) OVER w = 4 THEN list(r) OVER w END AS x FROM sx WINDOW w AS (PARTITION BY zone ORDER BY iso_year, iso_week ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)) WHERE n = 4"))
def w15_sliding_windows(spark, sf_dir):
    x = weekly_rain(spark, sf_dir).withColumn("r", F.when(F.col("n_days") >= 7, F.round("rain", 2)))
    w = series.sliding_windows(x, ["zone"], ["iso_year", "iso_week"], "r", 4)
    return w.select(*KEYS, F.coalesce(F.array_join(F.transform("window", lambda v: F.round(v * 100).cast("long")), ","), F.lit("")).alias("win"), "no_data")


@register("w8_dedup_latest", sql(RV, WEEKLY + ", rl AS (SELECT zone, iso_year, iso_week, unnest([0, 1, 2]) AS run, rain FROM wr)" + f" SELECT {K}, {rd('arg_max(rain * (run + 1), run)', 'rain')}, CAST(max(run) AS INT) AS run FROM rl GROUP BY 1, 2, 3"))
def w8_dedup_latest(spark, sf_dir):
    x = weekly_rain(spark, sf_dir).select(*KEYS, "rain").withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn("rain", F.col("rain") * (F.col("run") + 1))
    return tidy(series.dedup_latest(x, KEYS, "run"))


LOG = """, lg AS (SELECT zone, iso_year, iso_week, run, CASE WHEN run = 2 AND iso_week % 5 > 0 THEN 7 ELSE 3 + run END AS n_days_rain, CASE WHEN iso_week % 7 = 0 THEN 6 ELSE 7 END AS n_days_weather, run < 2 AS is_rolling FROM (SELECT zone, iso_year, iso_week, unnest([0, 1, 2]) AS run FROM wr))
, ok AS (SELECT *, n_days_rain = 7 AND n_days_weather = 7 AND NOT is_rolling AS good FROM lg)"""


def run_log(spark, sf_dir):
    x = weekly_rain(spark, sf_dir).select(*KEYS).withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return x.withColumns({
        "n_days_rain": F.when((F.col("run") == 2) & (F.col("iso_week") % 5 > 0), 7).otherwise(3 + F.col("run")), "n_days_weather": F.when(F.col("iso_week") % 7 == 0, 6).otherwise(7), "is_rolling": F.col("run") < 2,
    })


@register("j14_incomplete_keys", sql(RV, WEEKLY + LOG + f"SELECT {K} FROM ok GROUP BY 1, 2, 3 HAVING NOT bool_or(good)"))
def j14_incomplete_keys(spark, sf_dir):
    return series.incomplete_keys(run_log(spark, sf_dir), KEYS)


@register("w12_select_prediction_week", sql(RV, WEEKLY + LOG + "SELECT zone, CAST(max(CASE WHEN good AND iso_year * 100 + iso_week <= 199930 THEN iso_year * 100 + iso_week END) AS INT) AS week_code, CASE WHEN max(CASE WHEN good AND iso_year * 100 + iso_week <= 199930 THEN iso_year * 100 + iso_week END) IS NULL THEN 'blocked' WHEN max(CASE WHEN good AND iso_year * 100 + iso_week <= 199930 THEN iso_year * 100 + iso_week END) = 199930 THEN 'ok' ELSE 'fallback' END AS status FROM ok GROUP BY 1"))
def w12_select_prediction_week(spark, sf_dir):
    return series.select_prediction_week(run_log(spark, sf_dir), ["zone"], 1999, 30)


@register("w19_backfill_candidates", sql(RV, WEEKLY + LOG + f"""
, inc AS (SELECT zone, iso_year, iso_week, DATE '2001-11-10' - (CAST(date_trunc('week', make_date(iso_year, 1, 4)) AS DATE) + 7 * (iso_week - 1) + 6) AS age FROM ok GROUP BY 1, 2, 3 HAVING NOT bool_or(good))
, rk AS (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY iso_year DESC, iso_week DESC) AS k FROM inc)
SELECT {K}, CAST(age AS INT) AS age_days, CAST(k AS INT) AS rank, CASE WHEN age < 14 THEN 'too_young' WHEN sum(CAST(age >= 14 AS INT)) OVER (PARTITION BY zone ORDER BY k) <= 2 THEN 'picked' ELSE 'later' END AS decision FROM rk WHERE k <= 12"""))
def w19_backfill_candidates(spark, sf_dir):
    return series.backfill_candidates(run_log(spark, sf_dir), ["zone"], "2001-11-10")


@register("w11_latest_complete_row", sql(RV, WEEKLY + f"SELECT zone, CAST(max(iso_year * 100 + iso_week) / 1 AS INT) AS code, {rd('arg_max(rain, iso_year * 100 + iso_week)', 'rain')} FROM (SELECT * FROM wr WHERE n_days = 7) GROUP BY 1"))
def w11_latest_complete_row(spark, sf_dir):
    x = weekly_rain(spark, sf_dir).withColumn("whole", F.when(F.col("n_days") == 7, F.col("rain")))
    y = series.latest_complete_row(x, ["zone"], ["whole"], ["iso_year", "iso_week"])
    return tidy(y.select("zone", (F.col("iso_year") * 100 + F.col("iso_week")).alias("code"), "rain"))


def matrix(spark, sf_dir):
    x = climate(spark, sf_dir)
    target = x.select(*KEYS, (F.col("et0") * 100).alias("target"), F.lit(0.0).alias("rain"))
    return features.feature_matrix(target, x.select(*KEYS, "rain", "et0", "vpd", "p_eff"), view(spark, sf_dir, "monthly_index"))


W = "(PARTITION BY zone ORDER BY iso_year, iso_week)"
MATRIX = """, mx AS (SELECT c.*, et0 * 100 AS target, mei FROM clim c LEFT JOIN monthly_index m ON m.year = year(CAST(date_trunc('week', make_date(iso_year, 1, 4)) AS DATE) + 7 * (iso_week - 1)) AND m.month = month(CAST(date_trunc('week', make_date(iso_year, 1, 4)) AS DATE) + 7 * (iso_week - 1)))
, nx AS (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY iso_year, iso_week) AS k FROM mx)
, fx AS (SELECT *, last_value(mei IGNORE NULLS) OVER b AS a, last_value(CASE WHEN mei IS NOT NULL THEN k END IGNORE NULLS) OVER b AS i, first_value(mei IGNORE NULLS) OVER c AS z, first_value(CASE WHEN mei IS NOT NULL THEN k END IGNORE NULLS) OVER c AS j FROM nx WINDOW b AS (PARTITION BY zone ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), c AS (PARTITION BY zone ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
, gx AS (SELECT * EXCLUDE (mei), coalesce(mei, a + (k - i) * (z - a) / nullif(j - i, 0), a, z) AS mei FROM fx)"""


@register("l1_build_feature_matrix", sql(RV + " monthly_index", WEEKLY + CLIMATE + MATRIX + f""" SELECT {K}, {rd('target', 'target')}, {rd('rain', 'rain')}, {rd('p_eff', 'effective_rain')}, {rd('mei4', 'mei_lag4')}, {rd('t12', 'target_lag12')}, {rd('v2', 'vpd_lag2')}, {rd('m8', 'target_mean8')}, {rd('y1', 'y_h1')}, {rd('y12', 'y_h12')} FROM (
 SELECT *, lag(mei, 4) OVER {W} AS mei4, lag(target, 12) OVER {W} AS t12, lag(vpd, 2) OVER {W} AS v2, CASE WHEN count(target) OVER w8 = 8 THEN avg(target) OVER w8 END AS m8, lead(target, 1) OVER {W} AS y1, lead(target, 12) OVER {W} AS y12 FROM gx WINDOW w8 AS (PARTITION BY zone ORDER BY iso_year, iso_week ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)) WHERE y1 IS NOT NULL"""))
def l1_build_feature_matrix(spark, sf_dir):
    return tidy(matrix(spark, sf_dir).select(*KEYS, "target", "rain", "effective_rain", "mei_lag4", "target_lag12", "vpd_lag2", "target_mean8", "y_h1", "y_h12"))


@register("l15_readiness_and_source", sql(RV + " monthly_index", WEEKLY + CLIMATE + "SELECT zone, 'absent' || CASE WHEN zone = 'B' THEN ',rain' ELSE '' END AS missing, 'static' AS source FROM clim GROUP BY zone"))
def l15_readiness_and_source(spark, sf_dir):
    x = climate(spark, sf_dir).withColumn("rain", F.when(F.col("zone") == "A", F.col("rain")))
    return features.readiness(x, ["et0", "rain", "vpd", "absent"], ["zone"])


@register("p14_drop_all_null_columns", sql(RV, WEEKLY + f"SELECT {K}, {rd("CASE WHEN zone = 'A' THEN rain END", 'rain')}, n_days FROM wr"))
def p14_drop_all_null_columns(spark, sf_dir):
    x = weekly_rain(spark, sf_dir).select(*KEYS, F.when(F.col("zone") == "A", F.col("rain")).alias("rain"), F.when(F.col("zone") == "C", F.col("rain")).alias("never"), "n_days")
    return tidy(features.drop_all_null_columns(x, ["rain", "never", "n_days"]))


@register("p12_align_schema", "WITH x AS (SELECT * FROM orders) SELECT o_orderkey AS line, CAST(o_custkey AS VARCHAR) AS a, o_orderstatus AS b, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'new' END AS c FROM x")
def p12_align_schema(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = o.select(F.col("o_orderkey").alias("line"), F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws(",", F.col("o_orderstatus"), F.col("o_custkey").cast("string"))).otherwise(F.concat_ws(",", F.col("o_custkey").cast("string"), F.lit("new"), F.col("o_orderstatus"))).alias("value"))
    return readers.align_schema(lines, ["b", "a"], ["a", "c", "b"])


@register("s10_write_idempotent", sql(RV, WEEKLY + f"SELECT {K}, {rd('CASE WHEN iso_year >= 2000 THEN rain * 2 ELSE rain END', 'rain')} FROM wr"))
def s10_write_idempotent(spark, sf_dir):
    x = weekly_rain(spark, sf_dir).select(*KEYS, "rain")
    path = fresh_path(spark, "weekly")
    readers.write_idempotent(x, path, "iso_year")
    for _ in range(2):  # the same keys again: replaced, not added
        readers.write_idempotent(x.where("iso_year >= 2000").withColumn("rain", F.col("rain") * 2), path, "iso_year")
    return tidy(spark.read.parquet(path).select(*KEYS, "rain"))


@register("s11_append_run_log", sql(RV, WEEKLY + f"SELECT {K}, {rd('rain', 'rain')}, extra FROM wr CROSS JOIN (SELECT NULL::VARCHAR AS extra UNION ALL SELECT 'second')"))
def s11_append_run_log(spark, sf_dir):
    x = weekly_rain(spark, sf_dir).select(*KEYS, "rain")
    path = fresh_path(spark, "run-log")
    runs = features.align_union([x, x.withColumn("extra", F.lit("second"))])
    for run in (runs.where("extra IS NULL"), runs.where("extra IS NOT NULL")):
        readers.append_run_log(run, path, [*KEYS, "rain", "extra"])
    return tidy(spark.read.parquet(path).select(*KEYS, "rain", "extra"))


@register("l2_split_by_year", sql("predictions", "SELECT split, count(*) AS n, CAST(min(year) AS INT) AS first_year, CAST(max(year) AS INT) AS last_year FROM predictions GROUP BY 1"))
def l2_split_by_year(spark, sf_dir):
    p = view(spark, sf_dir, "predictions")
    part = F.when(F.col("year") < 1998, "train").when(F.col("year") < 2000, "calib").otherwise("test")
    return p.groupBy(part.alias("split")).agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
