"""Queries: calendar and scalar expressions, rain, weather, indices, weekly series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolake.functions import scalar as S
from hydrolake.operators import features, lookups, series
from hydrolake.plans.helpers import WEEKLY, dt, rd, sql, tidy
from hydrolake.plans.registry import register
from hydrolake.sources import readers
from hydrolake.sources.shared import fresh_path
from hydrolake.sources.views import view

K = "zone, iso_year, iso_week"
DAYS = ", days AS (SELECT DISTINCT date FROM rain_daily)"


def rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "rain_daily")


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rain(spark, sf_dir).select("date").distinct()


def wet0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather with ET0, deficit and degrees."""
    w = view(spark, sf_dir, "weather_daily")
    rh, vpd = S.humidity_and_deficit("t2m", "d2m")
    return w.withColumns({"et0": S.et0_penman_monteith("t2m", "d2m", "u10", "v10", "ssr", "str"), "rh": rh, "vpd": vpd, "t": F.col("t2m") - 273.15})


def weekly_rain(spark, sf_dir):
    return series.weekly_rain(rain(spark, sf_dir))


def weekly_weather(spark, sf_dir):
    return series.weekly_weather(wet0(spark, sf_dir), ["et0"], ["vpd", "t"]).withColumnRenamed("t", "t_mean")


def climate(spark, sf_dir):
    """Weeks with both rain and weather, imputed rain weeks included."""
    filled = series.impute_weeks(weekly_rain(spark, sf_dir), ["rain"])
    x = filled.join(weekly_weather(spark, sf_dir).drop("n_days"), ["zone", "iso_year", "iso_week"])
    return x.withColumn("p_eff", S.effective_rain("rain", F.when(F.col("zone") == "A", "paddy").otherwise("upland")))


MISSING = """, cal AS (SELECT zone, CAST(y AS INT) AS iso_year, CAST(w AS INT) AS iso_week FROM (SELECT zone, unnest(generate_series(min(iso_year), max(iso_year))) AS y FROM wr GROUP BY zone) CROSS JOIN range(1, 53) t(w))
, gone AS (SELECT * FROM cal ANTI JOIN wr USING (zone, iso_year, iso_week))"""
FILLED = MISSING + """, med AS (SELECT zone, iso_week, quantile_cont(rain, 0.5) AS m FROM wr GROUP BY 1, 2)
, filled AS (SELECT zone, iso_year, iso_week, rain, 0 AS imputed FROM wr UNION ALL SELECT g.zone, g.iso_year, g.iso_week, coalesce(round(m, 3), 0e0), 1 FROM gone g LEFT JOIN med USING (zone, iso_week))"""
CLIMATE = FILLED + """, clim AS (SELECT f.zone, f.iso_year, f.iso_week, f.rain, f.imputed, w.et0, w.vpd, w.t_mean, CASE WHEN f.zone = 'A' THEN f.rain * 0.8e0 ELSE greatest(0e0, f.rain - 5) * 0.85e0 END AS p_eff FROM filled f JOIN ww w USING (zone, iso_year, iso_week))"""
RV = "rain_daily weather_daily"
RVH, HOLEY = "rain_daily rain_holes weather_daily", WEEKLY.replace("FROM rain_daily", "FROM rain_holes")


@register("p1_iso_week", sql("rain_daily", DAYS + f"SELECT {dt('date', 'date')}, CAST(isoyear(date) AS INT) AS iso_year, CAST(week(date) AS INT) AS iso_week, CAST(isodow(date) AS INT) AS weekday, {dt("date_trunc('week', date)", 'week_start')} FROM days"))
def p1_iso_week(spark, sf_dir):
    return tidy(days(spark, sf_dir).select("date", S.iso_year("date").alias("iso_year"), S.iso_week("date").alias("iso_week"), S.weekday("date").alias("weekday"), S.monday("date").alias("week_start")))


@register("p2_week_start", sql("rain_daily", f"SELECT DISTINCT CAST(isoyear(date) AS INT) AS iso_year, CAST(week(date) AS INT) AS iso_week, {dt("date_trunc('week', date)", 'week_start')} FROM rain_daily"))
def p2_week_start(spark, sf_dir):
    x = rain(spark, sf_dir).select(S.iso_year("date").alias("iso_year"), S.iso_week("date").alias("iso_week")).distinct()
    return tidy(x.withColumn("week_start", S.week_start("iso_year", "iso_week")))


@register("p3_season", sql("rain_daily", DAYS + f"""SELECT {dt('date', 'date')}, CASE WHEN w BETWEEN 10 AND 18 THEN 'summer' WHEN w BETWEEN 19 AND 44 THEN 'rainy' ELSE 'winter' END AS three,
 CASE WHEN w BETWEEN 10 AND 18 THEN 'summer' WHEN w BETWEEN 22 AND 40 THEN 'rainy' ELSE 'other' END AS dry_to_40, CASE WHEN w BETWEEN 18 AND 44 THEN 'wet' ELSE 'dry' END AS two,
 CAST(CASE WHEN w BETWEEN 10 AND 18 THEN 1 WHEN w BETWEEN 19 AND 44 THEN 2 ELSE 0 END AS INT) AS season_enc FROM (SELECT date, week(date) AS w FROM days)"""))
def p3_season(spark, sf_dir):
    w = S.iso_week("date")
    return tidy(days(spark, sf_dir).select("date", *[S.season(w, s).alias(s) for s in S.SEASON_SCHEMES], S.season_code(w).alias("season_enc")))


@register("p4_cyclic", sql("rain_daily", DAYS + f"SELECT {dt('date', 'date')}, {rd('sin(2 * pi() * week(date) / 52)', 'ws', 6)}, {rd('cos(2 * pi() * week(date) / 52)', 'wc', 6)}, {rd('sin(2 * pi() * month(date) / 12)', 'ms', 6)}, {rd('cos(2 * pi() * month(date) / 12)', 'mc', 6)} FROM days"))
def p4_cyclic(spark, sf_dir):
    (ws, wc), (ms, mc) = S.cyclic(S.iso_week("date"), 52), S.cyclic(F.month("date"), 12)
    return tidy(days(spark, sf_dir).select("date", ws.alias("ws"), wc.alias("wc"), ms.alias("ms"), mc.alias("mc")), 6)


@register("p5_effective_rain", sql("rain_daily", f"SELECT zone, {dt('date', 'date')}, {rd('greatest(0e0, precipitation - 5) * 0.85e0', 'upland')}, {rd('precipitation * 0.8e0', 'paddy')} FROM rain_daily"))
def p5_effective_rain(spark, sf_dir):
    return tidy(rain(spark, sf_dir).select("zone", "date", S.effective_rain("precipitation", F.lit("upland")).alias("upland"), S.effective_rain("precipitation", F.lit("paddy")).alias("paddy")))


@register("p6_et0_penman_monteith", sql(RV, WEEKLY + f"SELECT zone, {dt('date', 'date')}, {rd('et0', 'et0')}, {rd('rh', 'rh')}, {rd('vpd', 'vpd')} FROM we"))
def p6_et0_penman_monteith(spark, sf_dir):
    return tidy(wet0(spark, sf_dir).select("zone", "date", "et0", "rh", "vpd"))


@register("p7_weir_flow", sql("telemetry_long", f"SELECT row_id, {rd('1.82e0 * 30 * pow(greatest(0e0, value - 0.155e0 - 489.545e0), 1.5e0)', 'q_m3s', 6)}, {rd('3600 * 1.82e0 * 30 * pow(greatest(0e0, value - 489.545e0), 1.5e0)', 'q_m3h', 3)} FROM telemetry_long WHERE data_type = 'water_level'"))
def p7_weir_flow(spark, sf_dir):
    x = view(spark, sf_dir, "telemetry_long").where("data_type = 'water_level'")
    return x.select("row_id", (F.round(S.weir_flow("value"), 6) + 0.0).alias("q_m3s"), (F.round(3600 * S.weir_flow("value", offset=0.0), 3) + 0.0).alias("q_m3h"))


@register("p8_aridity", sql(RV, WEEKLY + CLIMATE + f"""SELECT {K}, {rd('least(et0 / (rain + 0.001e0), 10e0)', 'training', 3)}, {rd('CASE WHEN r <> 0 THEN et0 / r END', 'live')}, CASE WHEN r IS NULL THEN 'rain_missing' WHEN r = 0 THEN 'rain_zero' ELSE '' END AS reasons
 FROM (SELECT *, CASE WHEN imputed = 1 THEN NULL ELSE rain END AS r FROM clim)"""))
def p8_aridity(spark, sf_dir):
    x = climate(spark, sf_dir).withColumn("r", F.when(F.col("imputed") == 0, F.col("rain")))
    return tidy(x.select("zone", "iso_year", "iso_week", S.aridity("et0", "rain").alias("training"), S.aridity("et0", "r", "live").alias("live"), F.concat_ws(",", S.aridity_reasons("et0", "r")).alias("reasons")))


@register("p17_staleness", sql("rain_daily", DAYS + f"SELECT {dt('date', 'date')}, CASE WHEN g <= 3 THEN 'ok' WHEN g <= 14 THEN 'warning' ELSE 'blocked' END AS status FROM (SELECT date, DATE '2001-09-01' - date AS g FROM days)"))
def p17_staleness(spark, sf_dir):
    return tidy(days(spark, sf_dir).select("date", S.staleness("date", F.lit("2001-09-01").cast("date")).alias("status")))


@register("p18_reporting_lag_risk", sql("monthly_index", "SELECT year, month, coalesce(x = a AND x = b, FALSE) AS risk FROM (SELECT year, month, round(mei / 3) AS x, lag(round(mei / 3), 4) OVER w AS a, lag(round(mei / 3), 8) OVER w AS b FROM monthly_index WINDOW w AS (ORDER BY year, month))"))
def p18_reporting_lag_risk(spark, sf_dir):
    x = series.row_lags(view(spark, sf_dir, "monthly_index").withColumn("x", F.round(F.col("mei") / 3)).withColumn("s", F.lit("index")), ["s"], ["year", "month"], "x", [4, 8])
    return x.select("year", "month", S.lag_risk("x", "x_lag4", "x_lag8").alias("risk"))


@register("p20_clamp_week", sql("rain_daily", DAYS + f"SELECT {dt('date', 'date')}, CAST(least(week(date), 52) AS INT) AS week FROM days"))
def p20_clamp_week(spark, sf_dir):
    return tidy(days(spark, sf_dir).select("date", S.clamp_week(S.iso_week("date")).alias("week")))


@register("p25_partial_week", sql("rain_daily", DAYS + f"SELECT {dt('date', 'date')}, isodow(date) <> 7 AS partial FROM days"))
def p25_partial_week(spark, sf_dir):
    return tidy(days(spark, sf_dir).select("date", S.partial_week("date").alias("partial")))


@register("p23_quality_checks", sql(RV, WEEKLY + CLIMATE + """, q AS (SELECT count(*) FILTER (WHERE et0 < 0) AS et0_negative, count(*) FILTER (WHERE rain < 0) AS rain_negative, count(*) FILTER (WHERE p_eff > rain + 0.01e0) AS p_eff_over_rain, count(*) FILTER (WHERE round(least(et0 / (rain + 0.001e0), 10e0), 3) > 10) AS aridity_over_10, count(*) FILTER (WHERE imputed = 1) AS imputed FROM clim)
 SELECT rule, n, n = 0 OR rule = 'imputed' AS passed FROM (SELECT 'et0_negative' AS rule, et0_negative AS n FROM q UNION ALL SELECT 'rain_negative', rain_negative FROM q UNION ALL SELECT 'p_eff_over_rain', p_eff_over_rain FROM q UNION ALL SELECT 'aridity_over_10', aridity_over_10 FROM q UNION ALL SELECT 'spi_missing', 0 FROM q UNION ALL SELECT 'imputed', imputed FROM q)"""))
def p23_quality_checks(spark, sf_dir):
    x = series.spi4(climate(spark, sf_dir)).withColumn("aridity", S.aridity("et0", "rain"))
    return features.quality_checks(x)


def index_lines(spark, sf_dir):
    x = view(spark, sf_dir, "monthly_index").withColumn("t", F.coalesce(F.col("mei").cast("string"), F.lit("-999")))
    known = F.map_from_entries(F.collect_list(F.struct("month", "t")))
    months = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.coalesce(F.try_element_at("_known", m), F.lit("-999")))
    good = x.groupBy("year").agg(known.alias("_known")).select("year", months.alias("m")).select(F.concat_ws("  ", F.col("year").cast("string"), F.array_join("m", " ")).alias("value"))
    # a header and a short line beside each year
    bad = good.select(F.lit("YEAR DJ JF FM MA AM MJ JJ JA AS SO ON ND").alias("value")).union(good.select(F.substring_index("value", " ", 4).alias("value")))
    return good.union(bad)


@register("s5_parse_bimonthly_index", sql("monthly_index", f"SELECT y.year, m.month, {rd('mei', 'mei')} FROM (SELECT DISTINCT year FROM monthly_index) y CROSS JOIN (SELECT CAST(range AS INT) AS month FROM range(1, 13)) m LEFT JOIN monthly_index USING (year, month)"))
def s5_parse_bimonthly_index(spark, sf_dir):
    return tidy(readers.parse_bimonthly_index(index_lines(spark, sf_dir)))


@register("s6_parse_season_index", sql("monthly_index", f"SELECT CAST(year * 12 + month AS BIGINT) AS line, concat('S', CAST(month AS VARCHAR)) AS season, year, {rd('mei + 27', 'total')}, {rd('mei', 'anomaly')}, year * 12 + month = max(year * 12 + month) OVER () AS latest FROM monthly_index WHERE mei IS NOT NULL"))
def s6_parse_season_index(spark, sf_dir):
    x = view(spark, sf_dir, "monthly_index").select((F.col("year") * 12 + F.col("month")).cast("long").alias("line"), F.concat_ws(" ", F.concat(F.lit("S"), "month"), "year", F.coalesce((F.col("mei") + 27).cast("string"), F.lit("x")), F.coalesce(F.col("mei").cast("string"), F.lit("x"))).alias("value"))
    rows, latest = readers.parse_season_index(x, "line")
    return tidy(rows.join(latest.select("line", F.lit(True).alias("latest")), "line", "left").withColumn("latest", F.coalesce("latest", F.lit(False))))


@register("s8_read_monthly_daily_table", sql("rain_daily", f"SELECT zone, {dt('date', 'date')}, {rd('max(precipitation)', 'value')} FROM rain_daily GROUP BY 1, date"))
def s8_read_monthly_daily_table(spark, sf_dir):
    x = rain(spark, sf_dir).select("zone", F.year("date").alias("year"), F.month("date").alias("month"), F.concat(F.lit(" "), F.day("date").cast("string")).alias("day"), F.col("precipitation").alias("value"), F.lit(2).alias("line"))
    old = x.withColumn("value", F.lit(-1.0)).withColumn("line", F.lit(1))
    odd = x.withColumn("day", F.lit("31x")).unionByName(x.withColumn("day", F.lit("31")).where("month = 2"))
    return tidy(readers.read_monthly_daily_table(old.unionByName(x).unionByName(odd), "line", ["zone"]).select("zone", "date", "value"))


@register("s9_read_year_week_history", sql("rain_daily", "SELECT DISTINCT CAST(isoyear(date) AS INT) AS year, CAST(week(date) AS INT) AS week FROM rain_daily"))
def s9_read_year_week_history(spark, sf_dir):
    path = fresh_path(spark, "history")
    rain(spark, sf_dir).select("zone", S.iso_year("date").alias("year"), S.iso_week("date").alias("week")).write.option("header", True).csv(path)
    return readers.read_year_week_history(spark, path, ["year", "week"]).select(F.col("year").cast("int"), F.col("week").cast("int"))


@register("a5_weekly_rain", sql(RV, WEEKLY + f"SELECT {K}, {rd('rain', 'rain')}, n_days, data_type FROM wr"))
def a5_weekly_rain(spark, sf_dir):
    return tidy(weekly_rain(spark, sf_dir))


@register("a6_weekly_weather", sql(RV, WEEKLY + f"SELECT {K}, {rd('et0', 'et0')}, {rd('vpd', 'vpd')}, {rd('t_mean', 't_mean')}, n_days FROM ww"))
def a6_weekly_weather(spark, sf_dir):
    return tidy(weekly_weather(spark, sf_dir))


@register("a7_spatial_mean_daily", f"WITH g AS (SELECT CAST(o_orderdate AS DATE) AS date, o_custkey % 10 AS cell, avg(CAST(round(o_totalprice) AS BIGINT)) AS t, sum(CASE WHEN o_orderkey % 3 = 0 THEN CAST(round(o_totalprice) AS BIGINT) END) AS d FROM orders GROUP BY 1, 2) SELECT {dt('date', 'date')}, {rd('avg(t)', 't', 3)}, {rd('avg(d)', 'd', 3)} FROM g GROUP BY date HAVING avg(d) IS NOT NULL")
def a7_spatial_mean_daily(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 10).alias("cell"), F.round("o_totalprice").cast("long").alias("p"), (F.col("o_orderkey") % 3 == 0).alias("k"))
    grid = o.groupBy("date", "cell").agg(F.avg("p").alias("t"), F.sum(F.when(F.col("k"), F.col("p"))).alias("d"))
    return tidy(series.spatial_mean(grid, ["date"], ["t", "d"]), 3)


@register("a8_climatology_median", sql(RV, WEEKLY + f"SELECT zone, iso_week, {rd('quantile_cont(rain, 0.5)', 'rain')} FROM wr GROUP BY 1, 2"))
def a8_climatology_median(spark, sf_dir):
    return tidy(series.climatology(weekly_rain(spark, sf_dir), ["zone", "iso_week"], ["rain"]))


@register("a9_impute_missing_weeks", sql(RVH, HOLEY + FILLED + f"SELECT {K}, {rd('rain', 'rain', 3)}, imputed FROM filled"))
def a9_impute_missing_weeks(spark, sf_dir):
    return tidy(series.impute_weeks(series.weekly_rain(view(spark, sf_dir, "rain_holes")), ["rain"]), 3)


SPI = """, r4 AS (SELECT zone, iso_year, iso_week, CASE WHEN count(rain) OVER w = 4 THEN sum(rain) OVER w END AS rain4 FROM wr WINDOW w AS (PARTITION BY zone ORDER BY iso_year, iso_week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
, spi AS (SELECT zone, iso_year, iso_week, rain4, round(coalesce(CASE WHEN count(rain4) OVER g = count(*) OVER g THEN (rain4 - avg(rain4) OVER g) / nullif(stddev_samp(rain4) OVER g, 0) END, 0e0), 3) + 0e0 AS spi4 FROM r4 WINDOW g AS (PARTITION BY zone, iso_week))"""


@register("a10_spi4", sql(RV, WEEKLY + SPI + f"SELECT {K}, {rd('spi4', 'spi4', 3)}, CAST(spi4 < -1 AS INT) AS drought_flag FROM spi"))
def a10_spi4(spark, sf_dir):
    return tidy(series.spi4(weekly_rain(spark, sf_dir)).select("zone", "iso_year", "iso_week", "spi4", "drought_flag"), 3)


@register("w3_rolling_sum", sql(RV, WEEKLY + SPI + f"SELECT {K}, {rd('rain4', 'rain4')} FROM r4"))
def w3_rolling_sum(spark, sf_dir):
    return tidy(series.rolling_sum(weekly_rain(spark, sf_dir), ["zone"], ["iso_year", "iso_week"], "rain", 4, "rain4").select("zone", "iso_year", "iso_week", "rain4"))


@register("a18_seasonal_annual_summary", sql(RV, WEEKLY + CLIMATE + SPI + f"""
, s AS (SELECT c.*, p.spi4, CASE WHEN c.iso_week BETWEEN 10 AND 18 THEN 'summer' WHEN c.iso_week BETWEEN 19 AND 44 THEN 'rainy' ELSE 'winter' END AS season, CAST(coalesce(p.spi4, 0) < -1 AS INT) AS f FROM clim c JOIN spi p USING (zone, iso_year, iso_week))
SELECT zone, season, NULL::INT AS iso_year, {rd('avg(et0)', 'et0_mean')}, {rd('avg(rain)', 'rain_mean')}, {rd('sum(et0)', 'et0_sum')}, {rd('sum(rain)', 'rain_sum')}, {rd('avg(f)', 'drought_share')}, CASE WHEN sum(et0) > sum(rain) THEN 'deficit' ELSE 'surplus' END AS status FROM s GROUP BY 1, 2
UNION ALL SELECT zone, NULL, iso_year, {rd('avg(et0)', 'et0_mean')}, {rd('avg(rain)', 'rain_mean')}, {rd('sum(et0)', 'et0_sum')}, {rd('sum(rain)', 'rain_sum')}, {rd('avg(f)', 'drought_share')}, CASE WHEN sum(et0) > sum(rain) THEN 'deficit' ELSE 'surplus' END FROM s GROUP BY 1, 3"""))
def a18_seasonal_annual_summary(spark, sf_dir):
    from hydrolake.operators import demand

    flags = series.spi4(weekly_rain(spark, sf_dir)).select("zone", "iso_year", "iso_week", "drought_flag")
    x = climate(spark, sf_dir).join(flags, ["zone", "iso_year", "iso_week"]).withColumn("season", S.season("iso_week"))
    return tidy(demand.season_summary(x))


@register("a42_history_years", sql(RV, WEEKLY + "SELECT zone, iso_week, count(DISTINCT iso_year) AS years FROM wr GROUP BY 1, 2"))
def a42_history_years(spark, sf_dir):
    return weekly_rain(spark, sf_dir).groupBy("zone", "iso_week").agg(F.count_distinct("iso_year").alias("years"))


@register("j8_climate_join", sql(RV, WEEKLY + CLIMATE + f"SELECT {K}, {rd('rain', 'rain', 3)}, {rd('et0', 'et0')}, {rd('p_eff', 'p_eff')}, imputed FROM clim"))
def j8_climate_join(spark, sf_dir):
    x = climate(spark, sf_dir).withColumn("rain", F.round("rain", 3))
    return tidy(x.select("zone", "iso_year", "iso_week", "rain", "et0", "p_eff", "imputed"))


MONTHS = ", mj AS (SELECT w.zone, w.iso_year, w.iso_week, CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month FROM (SELECT *, CAST(date_trunc('week', make_date(iso_year, 1, 4)) AS DATE) + 7 * (iso_week - 1) AS m FROM wr) w)"


@register("j9_month_join", sql(RV + " monthly_index", WEEKLY + MONTHS + f"SELECT {K}, {rd('mei', 'mei')} FROM mj LEFT JOIN monthly_index USING (year, month)"))
def j9_month_join(spark, sf_dir):
    return tidy(features.week_month_join(weekly_rain(spark, sf_dir), view(spark, sf_dir, "monthly_index")).select("zone", "iso_year", "iso_week", "mei"))


@register("j10_drop_overlap_join", sql(RV, WEEKLY + f"SELECT {K}, {rd('rain', 'rain')}, data_type, w.n_days AS n_days, {rd('et0', 'et0')} FROM wr r LEFT JOIN (SELECT zone, iso_year, iso_week, et0, n_days FROM ww) w USING (zone, iso_year, iso_week)"))
def j10_drop_overlap_join(spark, sf_dir):
    x = lookups.drop_overlap_join(weekly_rain(spark, sf_dir), weekly_weather(spark, sf_dir).select("zone", "iso_year", "iso_week", "et0", "n_days"), ["zone", "iso_year", "iso_week"])
    return tidy(x)


@register("j11_missing_keys", sql(RVH, HOLEY + MISSING + f"SELECT {K} FROM gone"))
def j11_missing_keys(spark, sf_dir):
    w = series.weekly_rain(view(spark, sf_dir, "rain_holes"))
    return lookups.missing_keys(series.week_calendar(w, ["zone"]), w, ["zone", "iso_year", "iso_week"])


@register("j12_fresh_wins_union", sql(RV, WEEKLY + f"SELECT {K}, {rd('rain', 'rain')}, n_days, data_type FROM wr WHERE n_days = 7 UNION ALL SELECT {K}, {rd('rain * 2', 'rain')}, 7, 'historical' FROM wr WHERE n_days < 7"))
def j12_fresh_wins_union(spark, sf_dir):
    w = weekly_rain(spark, sf_dir)
    history = w.withColumns({"rain": F.col("rain") * 2, "n_days": F.lit(7).cast("long"), "data_type": F.lit("historical")})
    return tidy(lookups.fresh_wins(history, w.where("n_days = 7"), ["zone", "iso_year", "iso_week"]))


@register("j18_validation_join", sql(RV, WEEKLY + f"SELECT {K}, {rd('e.et0', 'et0')}, {rd('r.rain', 'sat')} FROM ww e JOIN (SELECT * FROM wr WHERE rain > 20) r USING (zone, iso_year, iso_week)"))
def j18_validation_join(spark, sf_dir):
    sat = weekly_rain(spark, sf_dir).select("zone", "iso_year", "iso_week", F.when(F.col("rain") > 20, F.col("rain")).alias("sat")).where("sat > 0")
    return tidy(weekly_weather(spark, sf_dir).select("zone", "iso_year", "iso_week", "et0").join(sat, ["zone", "iso_year", "iso_week"]))


@register("a35_linear_validation", sql(RV, WEEKLY + f"""
, v AS (SELECT e.zone, e.et0 AS x, r.rain AS y, CASE WHEN e.iso_week BETWEEN 10 AND 18 THEN 'summer' WHEN e.iso_week BETWEEN 19 AND 44 THEN 'rainy' ELSE 'winter' END AS season FROM ww e JOIN (SELECT * FROM wr WHERE rain > 20) r USING (zone, iso_year, iso_week))
SELECT zone, season, count(*) AS n, {rd('corr(x, y)', 'r')}, {rd('regr_slope(y, x)', 'slope')}, {rd('regr_intercept(y, x)', 'intercept')}, {rd('avg(y - x)', 'bias')}, {rd('sqrt(avg((y - x) * (y - x)))', 'rmse')} FROM v GROUP BY 1, 2 HAVING count(*) >= 3"""))
def a35_linear_validation(spark, sf_dir):
    from hydrolake.operators import skill

    sat = weekly_rain(spark, sf_dir).select("zone", "iso_year", "iso_week", F.col("rain").alias("y")).where("y > 20")
    x = weekly_weather(spark, sf_dir).select("zone", "iso_year", "iso_week", F.col("et0").alias("x")).join(sat, ["zone", "iso_year", "iso_week"])
    return tidy(skill.linear_validation(x.withColumn("season", S.season("iso_week")), ["zone", "season"], "x", "y"))


@register("w7_interpolate_fill", sql(RV + " monthly_index", """
, n AS (SELECT *, row_number() OVER (ORDER BY year, month) AS k FROM monthly_index)
, f AS (SELECT *, last_value(mei IGNORE NULLS) OVER b AS a, last_value(CASE WHEN mei IS NOT NULL THEN k END IGNORE NULLS) OVER b AS i, first_value(mei IGNORE NULLS) OVER c AS z, first_value(CASE WHEN mei IS NOT NULL THEN k END IGNORE NULLS) OVER c AS j FROM n WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), c AS (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT year, month, """ + rd("coalesce(mei, a + (k - i) * (z - a) / nullif(j - i, 0), a, z)", "mei") + " FROM f"))
def w7_interpolate_fill(spark, sf_dir):
    x = view(spark, sf_dir, "monthly_index").withColumn("s", F.lit("index"))
    return tidy(series.interpolate_fill(x, ["s"], ["year", "month"], "mei").drop("s"))


TIERED = ", tiers AS (SELECT zone, date, precipitation, data_type FROM rain_daily UNION ALL SELECT zone, date, precipitation + 1, 'prelim' FROM rain_daily WHERE month(date) < 4)"


def tiered(spark, sf_dir):
    x = rain(spark, sf_dir)
    return x.unionByName(x.where(F.month("date") < 4).withColumns({"precipitation": F.col("precipitation") + 1, "data_type": F.lit("prelim")}))


@register("w9_priority_dedup", sql("rain_daily", TIERED + f"SELECT zone, {dt('date', 'date')}, {rd('precipitation', 'precipitation')}, data_type FROM (SELECT *, row_number() OVER (PARTITION BY zone, date ORDER BY CASE data_type WHEN 'final' THEN 1 WHEN 'prelim_ftp' THEN 2 ELSE 3 END, precipitation DESC) AS k FROM tiers) WHERE k = 1"))
def w9_priority_dedup(spark, sf_dir):
    return tidy(series.priority_dedup(tiered(spark, sf_dir).select("zone", "date", "precipitation", "data_type"), ["zone", "date"]))


@register("w10_rolling_estimate", sql("rain_daily", f"SELECT zone, {rd('sum(precipitation)', 'rain')}, count(*) AS n_days, {dt('min(date)', 'first_day')}, {dt('max(date)', 'last_day')} FROM rain_daily JOIN (SELECT zone, max(date) AS fin FROM rain_daily WHERE date <= DATE '1999-06-16' GROUP BY 1) USING (zone) WHERE date <= fin AND date > fin - 7 GROUP BY 1"))
def w10_rolling_estimate(spark, sf_dir):
    return tidy(series.rolling_estimate(rain(spark, sf_dir), ["zone"], "1999-06-16"))


@register("g1_pentad_to_daily", sql("rain_daily", f"""
, p AS (SELECT zone, date AS s, precipitation AS v, CASE WHEN day(date) = 26 THEN last_day(date) ELSE date + 4 END AS e FROM rain_daily)
SELECT zone, {dt('s', 'start')}, {dt('d', 'date')}, {rd('v / (e - s + 1)', 'value')}, day(s) NOT IN (1, 6, 11, 16, 21, 26) AS odd_start FROM (SELECT *, unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM p)"""))
def g1_pentad_to_daily(spark, sf_dir):
    x = rain(spark, sf_dir).select("zone", F.col("date").alias("start"), F.col("precipitation").alias("value"))
    return tidy(series.pentad_to_daily(x))


@register("g2_week_skeleton", sql("rain_daily", f"""
, w AS (SELECT DISTINCT unnest(generate_series(date_trunc('week', a) - INTERVAL 56 DAY, date_trunc('week', a)::TIMESTAMP, INTERVAL 7 DAY)) AS m FROM (SELECT DISTINCT date AS a FROM rain_daily))
SELECT {dt('m', 'week_start')}, CAST(isoyear(m) AS INT) AS iso_year, CAST(week(m) AS INT) AS iso_week, CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month FROM w"""))
def g2_week_skeleton(spark, sf_dir):
    x = days(spark, sf_dir)
    return tidy(series.week_skeleton(x, "date", 8).select("week_start", "iso_year", "iso_week", "year", "month").distinct())


@register("g6_tier_schedule", sql("rain_daily", f"""
, have AS (SELECT DISTINCT zone, date FROM rain_daily WHERE data_type = 'final')
, s AS (SELECT zone, b, CAST(unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT zone, min(date) AS a, max(date) AS b FROM rain_daily GROUP BY 1))
SELECT s.zone, {dt('s.date', 'date')}, unnest(CASE WHEN s.date <= b + 1 - 50 THEN ['final'] ELSE ['prelim_ftp', 'prelim'] END) AS tier FROM s ANTI JOIN have USING (zone, date)"""))
def g6_tier_schedule(spark, sf_dir):
    """Each zone's days of rain, as of the day after its last; days that a final value covers need none."""
    r = rain(spark, sf_dir)
    spans = r.groupBy("zone").agg(F.min("date").alias("start"), F.max("date").alias("end"), F.date_add(F.max("date"), 1).alias("today"))
    have = r.where("data_type = 'final'").select("zone", "date").distinct()
    plan = series.tier_schedule(spans, ["zone"], 50).join(have, ["zone", "date"], "left_anti")
    return tidy(plan.select("zone", "date", F.explode("tiers").alias("tier")))


@register("g7_candidate_days", sql("rain_daily", DAYS + f"SELECT {dt('date', 'date')}, {dt("unnest(generate_series(CASE WHEN isodow(date) = 1 THEN date - INTERVAL 7 DAY ELSE date_trunc('week', date)::TIMESTAMP END, date - INTERVAL 1 DAY, INTERVAL 1 DAY))", 'candidate')} FROM days"))
def g7_candidate_days(spark, sf_dir):
    return tidy(series.candidate_days(days(spark, sf_dir), "date"))


@register("k1_sort", sql(RV, WEEKLY + f"SELECT {K}, {rd('rain', 'rain')} FROM wr ORDER BY {K}"))
def k1_sort(spark, sf_dir):
    return tidy(weekly_rain(spark, sf_dir).select("zone", "iso_year", "iso_week", "rain")).orderBy("zone", "iso_year", "iso_week")


@register("k2_top_per_group", sql(RV, WEEKLY + f"SELECT zone, iso_year, max(iso_week) AS iso_week, {rd('max(rain)', 'rain')} FROM (SELECT *, rank() OVER (PARTITION BY zone, iso_year ORDER BY rain DESC) AS k FROM wr) WHERE k = 1 GROUP BY 1, 2"))
def k2_top_per_group(spark, sf_dir):
    x = weekly_rain(spark, sf_dir).groupBy("zone", "iso_year").agg(F.max(F.struct("rain", "iso_week")).alias("x"))
    return tidy(x.select("zone", "iso_year", "x.iso_week", "x.rain"))


@register("k3_top_k", sql(RV, WEEKLY + f"SELECT {K}, {rd('rain', 'rain')} FROM wr ORDER BY round(wr.rain, 6) DESC, zone, iso_year, iso_week LIMIT 20"))
def k3_top_k(spark, sf_dir):
    return tidy(weekly_rain(spark, sf_dir).select("zone", "iso_year", "iso_week", "rain").orderBy(F.round("rain", 6).desc(), "zone", "iso_year", "iso_week").limit(20))


@register("k4_union_all", sql("rain_daily", TIERED + "SELECT zone, data_type, count(*) AS n FROM tiers GROUP BY 1, 2"))
def k4_union_all(spark, sf_dir):
    return tiered(spark, sf_dir).groupBy("zone", "data_type").agg(F.count(F.lit(1)).alias("n"))


@register("k5_set_difference", sql(RV, WEEKLY + "(SELECT iso_year, iso_week, 'only_rain' AS side FROM (SELECT iso_year, iso_week FROM wr EXCEPT SELECT iso_year, iso_week FROM ww)) UNION ALL SELECT iso_year, iso_week, 'both' FROM (SELECT iso_year, iso_week FROM wr INTERSECT SELECT iso_year, iso_week FROM ww)"))
def k5_set_difference(spark, sf_dir):
    a, b = weekly_rain(spark, sf_dir).select("iso_year", "iso_week"), weekly_weather(spark, sf_dir).select("iso_year", "iso_week")
    return a.subtract(b).withColumn("side", F.lit("only_rain")).unionByName(a.intersect(b).withColumn("side", F.lit("both")))


@register("k6_distinct", sql(RV, WEEKLY + "SELECT DISTINCT iso_year, iso_week FROM wr"))
def k6_distinct(spark, sf_dir):
    return weekly_rain(spark, sf_dir).dropDuplicates(["iso_year", "iso_week"]).select("iso_year", "iso_week")
