"""Queries: telemetry, lookups, reservoir balance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolake.functions import scalar as S
from hydrolake.operators import lookups, series, telemetry
from hydrolake.plans.helpers import LEVELS, MARKS, dt, rd, sql, tidy, tm
from hydrolake.plans.registry import register
from hydrolake.sources import readers
from hydrolake.sources.shared import fresh_path
from hydrolake.sources.views import view

TYPES = ("water_level", "rainfall_1h", "temperature", "humidity", "solar")
STATIONS = ("RES000", "RES001", "RES002", "RES003")


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "telemetry_long").where("data_type = 'water_level'").select("station", "ts", F.col("value").alias("level"), "row_id")


def wide_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide log as text: a row per time, a column per station and type."""
    x = view(spark, sf_dir, "telemetry_long").withColumn("metric", F.concat_ws("_", "station", "data_type"))
    names = [f"{s}_{t}" for s in STATIONS for t in TYPES]
    raw = x.groupBy(F.date_format("ts", "yyyy-M-d H:m:s").alias("measure_datetime")).pivot("metric", names).agg(F.max(F.round("value", 3)))
    return raw.select("measure_datetime", *[F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in names])


def hour_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = view(spark, sf_dir, "telemetry_long").where(F.col("data_type").isin("water_level", "rainfall_1h"))
    near = lookups.nearest_join(x, ["station", "data_type"])
    return near.groupBy("station", "mark").agg(F.max(F.when(F.col("data_type") == "water_level", F.col("value"))).alias("level"), F.max(F.when(F.col("data_type") == "rainfall_1h", F.col("value"))).alias("rain"))


WIDE = """, w AS (SELECT station, data_type, date_trunc('second', ts) AS s, max(round(value, 3)) AS v FROM telemetry_long GROUP BY 1, 2, 3)"""


@register("s1_read_wide_log", sql("telemetry_long", f"SELECT {tm('s', 'measure_datetime')}, count(*) AS n FROM (SELECT date_trunc('second', ts) AS s, station, data_type FROM telemetry_long GROUP BY ALL) GROUP BY s"))
def s1_read_wide_log(spark, sf_dir):
    wide, path = wide_text(spark, sf_dir), fresh_path(spark, "wide-log")
    wide.write.option("header", True).csv(path)
    log = readers.read_wide_log(spark, path, wide.columns)
    return tidy(readers.wide_to_long(log).groupBy("measure_datetime").agg(F.count(F.lit(1)).alias("n")))


@register("s2_wide_to_long", sql("telemetry_long", WIDE + f" SELECT {tm('s', 'measure_datetime')}, station, data_type, {rd('v', 'value', 3)} FROM w"))
def s2_wide_to_long(spark, sf_dir):
    return tidy(readers.wide_to_long(readers.wide_log(wide_text(spark, sf_dir))), 3)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = view(spark, sf_dir, "telemetry_long").withColumn("bin", (F.unix_micros(F.col("ts").cast("timestamp")) / 600_000_000).cast("long"))
    one = F.struct(F.col("station").alias("station_code"), F.col("station").alias("station_name"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("measure_datetime"), "data_type", F.round("value", 3).cast("string").alias("data"))
    data = F.transform(F.sort_array(F.collect_list(F.struct("row_id", one.alias("d")))), lambda s: s["d"])
    return x.groupBy("bin").agg(F.to_json(F.struct(F.lit("").alias("remark"), F.lit("p").alias("project_name"), data.alias("data"))).alias("payload"))


@register("s3_parse_telemetry_json", sql("telemetry_long", f"""
, x AS (SELECT *, CAST(floor(epoch_us(ts) / 6e8) AS BIGINT) AS bin FROM telemetry_long)
, g AS (SELECT bin, s.station, x.row_id, x.data_type, x.ts, round(x.value, 3) AS value FROM (SELECT DISTINCT bin FROM x) CROSS JOIN (SELECT unnest(['RES000','RES001','RES002','RES003']) AS station) s LEFT JOIN x USING (bin, station))
SELECT bin, station, {', '.join(f"{rd(f'''arg_max(value, row_id) FILTER (WHERE data_type = '{t}')''', t, 3)}" for t in (*TYPES, 'pressure'))},
 array_to_string(list_sort(list_filter(['water_level','rainfall_1h','temperature','humidity','pressure','solar'], lambda t: NOT list_contains(coalesce(list(data_type) FILTER (WHERE row_id IS NOT NULL), []), t))), ',') AS missing_types,
 count(row_id) > 0 AS found, strftime(min(ts) FILTER (WHERE TRUE), '%Y-%m-%d %H:%M:%S') AS measure_datetime,
 count(DISTINCT strftime(ts, '%Y-%m-%d %H:%M:%S')) > 1 AS mixed_times
FROM g GROUP BY bin, station"""))
def s3_parse_telemetry_json(spark, sf_dir):
    return tidy(readers.parse_telemetry_json(messages(spark, sf_dir), "payload", STATIONS, ids=["bin"]), 3)


@register("s4_read_curve", sql("rating_curve", f"SELECT station, count(*) AS n, {rd('min(level)', 'least')}, {rd('max(level)', 'most')}, bool_and(ok) AS rises FROM (SELECT *, storage_m3 >= coalesce(lag(storage_m3) OVER (PARTITION BY station ORDER BY level), -1e0) AS ok FROM rating_curve) GROUP BY station"))
def s4_read_curve(spark, sf_dir):
    from pyspark.sql import Window

    path = fresh_path(spark, "curves")
    curve = view(spark, sf_dir, "rating_curve").select("station", F.col("level").alias("msl_height"), "z_factor", F.col("area_m2").alias("surface_area_m2"), "storage_m3")
    curve.repartition("station").write.partitionBy("station").option("header", True).csv(path)  # a file per station
    c = readers.read_curve(spark, path, by="station").withColumnRenamed("msl_height", "level").withColumn("_p", F.lag("storage_m3").over(Window.partitionBy("station").orderBy("level")))
    return tidy(c.groupBy("station").agg(F.count(F.lit(1)).alias("n"), F.min("level").alias("least"), F.max("level").alias("most"), F.min(F.col("storage_m3") >= F.coalesce("_p", F.lit(-1.0))).alias("rises")))


@register("s7_read_release_events", sql("release_events", f"SELECT event_no, {tm("date_trunc('minute', start_ts)", 'start_ts')}, {tm("date_trunc('minute', end_ts)", 'end_ts')}, {rd('rate_m3_per_day', 'rate_m3_per_day')} FROM release_events"))
def s7_read_release_events(spark, sf_dir):
    e = view(spark, sf_dir, "release_events")
    text = lambda c, f: F.coalesce(F.date_format(c, f), F.lit(" "))
    raw = e.select("event_no", text("start_ts", "yyyy-MM-dd").alias("start_date"), text("start_ts", "H:m").alias("start_time"), text("end_ts", "yyyy-MM-dd").alias("end_date"), text("end_ts", "H:m").alias("end_time"), F.col("rate_m3_per_day").cast("string").alias("rate_m3_per_day"))
    return tidy(readers.read_release_events(raw).select("event_no", "start_ts", "end_ts", "rate_m3_per_day"))


@register("j1_floor_lookup", sql("telemetry_long rating_curve", LEVELS + f""" SELECT row_id, {rd("coalesce(c.area_m2, f.area_m2)", "area_m2")}, {rd("coalesce(c.storage_m3, f.storage_m3)", "storage_m3")}
 FROM (SELECT *, level + 1e-9 AS x FROM lv) l ASOF LEFT JOIN rating_curve c ON l.station = c.station AND l.x >= c.level
 LEFT JOIN (SELECT station, arg_min(area_m2, level) AS area_m2, arg_min(storage_m3, level) AS storage_m3 FROM rating_curve GROUP BY 1) f ON f.station = l.station"""))
def j1_floor_lookup(spark, sf_dir):
    return tidy(lookups.floor_lookup(levels(spark, sf_dir), view(spark, sf_dir, "rating_curve"), ["area_m2", "storage_m3"]).select("row_id", "area_m2", "storage_m3"))


@register("j2_interp_lookup", sql("telemetry_long rating_curve", LEVELS + f"""
, c AS (SELECT *, lead(level) OVER w AS hi, lead(storage_m3) OVER w AS s2, min(level) OVER (PARTITION BY station) AS lo_all, max(level) OVER (PARTITION BY station) AS hi_all FROM rating_curve WINDOW w AS (PARTITION BY station ORDER BY level))
, l AS (SELECT lv.*, greatest(least(lv.level, e.b), e.a) AS x, least(greatest(lv.level + 1e-9, e.a), e.b) AS z FROM lv JOIN (SELECT station, min(level) AS a, max(level) AS b FROM rating_curve GROUP BY 1) e USING (station))
SELECT row_id, {rd("CASE WHEN c.hi IS NULL THEN c.storage_m3 ELSE c.storage_m3 + (least(l.x, c.hi) - c.level) / (c.hi - c.level) * (c.s2 - c.storage_m3) END", "storage_m3", 3)}
FROM l ASOF JOIN c ON l.station = c.station AND l.z >= c.level"""))
def j2_interp_lookup(spark, sf_dir):
    return tidy(lookups.interp_lookup(levels(spark, sf_dir), view(spark, sf_dir, "rating_curve"), "storage_m3").select("row_id", "storage_m3"), 3)


@register("j3_nearest_join", sql("telemetry_long", MARKS + f"SELECT station, data_type, {tm('mark', 'mark')}, {tm('ts', 'ts')}, {rd('value', 'value')} FROM best"))
def j3_nearest_join(spark, sf_dir):
    x = view(spark, sf_dir, "telemetry_long").where(F.col("data_type").isin("water_level", "rainfall_1h"))
    return tidy(lookups.nearest_join(x, ["station", "data_type"]))


DAYS = ", d AS (SELECT DISTINCT station, CAST(ts AS DATE) AS date, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 7 HOUR AS ref_ts FROM telemetry_long)"
COVER = DAYS + ", cov AS (SELECT d.station, d.date, d.ref_ts, e.event_no, e.rate_m3_per_day FROM d JOIN release_events e ON d.station = e.station AND e.start_ts <= d.ref_ts AND (e.end_ts IS NULL OR d.ref_ts <= e.end_ts))"


def days_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = view(spark, sf_dir, "telemetry_long")
    return x.select("station", F.to_date("ts").alias("date")).distinct().withColumn("ref_ts", F.col("date").cast("timestamp_ntz") + F.expr("INTERVAL 7 HOUR"))


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release per station and day, and the events that began or ceased to be behind it."""
    swept = lookups.sweep_intervals(days_of(spark, sf_dir), view(spark, sf_dir, "release_events"), ["station"], "rate_m3_per_day", "event_no")
    return swept.select("station", "date", F.col("total").alias("release_m3"), "n_open", "opened", "closed")


@register("j4_point_in_interval", sql("telemetry_long release_events", COVER + f"""
, f AS (SELECT station, event_no, min(date) AS a, max(date) AS b FROM cov GROUP BY 1, 2)
, nx AS (SELECT station, date, lead(date) OVER (PARTITION BY station ORDER BY date) AS then FROM d)
, op AS (SELECT station, a AS date, string_agg(CAST(event_no AS VARCHAR), ',' ORDER BY event_no) AS opened FROM f GROUP BY 1, 2)
, cl AS (SELECT f.station, nx.then AS date, string_agg(CAST(event_no AS VARCHAR), ',' ORDER BY event_no) AS closed FROM f JOIN nx ON f.station = nx.station AND f.b = nx.date GROUP BY 1, 2)
SELECT d.station, {dt('d.date', 'date')}, {rd('coalesce(sum(rate_m3_per_day), 0)', 'release_m3')}, count(event_no) AS n_open, coalesce(any_value(opened), '') AS opened, coalesce(any_value(closed), '') AS closed, coalesce(string_agg(CAST(event_no AS VARCHAR), ',' ORDER BY event_no), '') AS note
FROM d LEFT JOIN cov USING (station, date) LEFT JOIN op USING (station, date) LEFT JOIN cl USING (station, date) GROUP BY d.station, d.date"""))
def j4_point_in_interval(spark, sf_dir):
    """All events that cover a day (note), and those that opened and closed since the day before."""
    listed = lambda c: F.array_join(F.transform(c, lambda n: n.cast("string")), ",").alias(c)
    swept = releases(spark, sf_dir).select("station", "date", "release_m3", "n_open", listed("opened"), listed("closed"))
    cover = lookups.point_in_interval(days_of(spark, sf_dir), view(spark, sf_dir, "release_events").select("event_no", "station", "start_ts", "end_ts"), ["station"])
    notes = cover.groupBy("station", "date").agg(F.array_sort(F.collect_list("event_no")).alias("note")).select("station", "date", listed("note"))
    return tidy(swept.join(notes, ["station", "date"], "left").fillna("", ["note"]))


OVERLAP = """, o AS (SELECT e.*, coalesce(end_ts, TIMESTAMP '2024-02-15 00:00:00') AS fin FROM release_events e)
, days AS (SELECT *, unnest(generate_series(date_trunc('day', start_ts), fin, INTERVAL 1 DAY)) AS day FROM o)
, h AS (SELECT *, greatest(0e0, (epoch_us(least(fin, day + INTERVAL 1 DAY)) - epoch_us(greatest(start_ts, day))) / 3.6e9) AS hours FROM days)"""


@register("j5_interval_overlap", sql("release_events valve_rates", OVERLAP + f"SELECT station, {dt('day', 'day')}, {rd('sum(hours * q_m3h)', 'release_m3')}, count(*) AS events FROM h JOIN valve_rates USING (outlet_side, turns) GROUP BY 1, 2"))
def j5_interval_overlap(spark, sf_dir):
    x = lookups.interval_overlap(view(spark, sf_dir, "release_events"), "2024-02-15 00:00:00").join(view(spark, sf_dir, "valve_rates"), ["outlet_side", "turns"])
    return tidy(x.groupBy("station", "day").agg(F.sum(F.col("hours") * F.col("q_m3h")).alias("release_m3"), F.count(F.lit(1)).alias("events")))


@register("j6_valve_flow", sql("release_events valve_rates", f"SELECT event_no, outlet_side, turns, {rd('q_m3h', 'q_m3h')} FROM release_events JOIN valve_rates USING (outlet_side, turns)"))
def j6_valve_flow(spark, sf_dir):
    x = lookups.exact_lookup(view(spark, sf_dir, "release_events"), view(spark, sf_dir, "valve_rates"), ["outlet_side", "turns"], "q_m3h")
    return tidy(x.select("event_no", "outlet_side", "turns", "q_m3h"))


FORMS = ", forms AS (SELECT concat('RES00', CAST(user_id % 4 AS VARCHAR)) AS station, CASE WHEN event_id % 3 = 0 THEN 'open' ELSE 'close' END AS kind, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 1 + event_id % 40 END AS event_no, event_id AS row_id FROM events WHERE event_type = 'signup')"
PAIRS = FORMS + """
, opens AS (SELECT station, row_number() OVER (PARTITION BY station ORDER BY row_id) AS event_no, row_id AS opened FROM forms WHERE kind = 'open')
, firsts AS (SELECT f.station, f.event_no, min(f.row_id) AS closed FROM forms f JOIN opens o ON f.station = o.station AND f.event_no = o.event_no AND f.kind = 'close' AND o.opened < f.row_id GROUP BY 1, 2)
, outcome AS (SELECT station, opened AS row_id, event_no, 'opened' AS outcome FROM opens
  UNION ALL SELECT f.station, f.row_id, f.event_no, CASE WHEN x.closed IS NULL THEN 'rejected' ELSE 'closed' END FROM forms f LEFT JOIN firsts x ON f.station = x.station AND f.event_no = x.event_no AND f.row_id = x.closed WHERE f.kind = 'close')"""


def forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'signup'")
    return e.selectExpr("concat('RES00', CAST(user_id % 4 AS STRING)) AS station", "CASE WHEN event_id % 3 = 0 THEN 'open' ELSE 'close' END AS kind", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 1 + event_id % 40 END AS event_no", "event_id AS row_id")


@register("j19_valve_pairing", f"WITH {PAIRS[2:]} SELECT station, row_id, event_no, outcome FROM outcome")
def j19_valve_pairing(spark, sf_dir):
    events, rejected = lookups.pair_valves(forms(spark, sf_dir), ["station"], "row_id")
    rows = events.select("station", F.col("opened").alias("row_id"), "event_no", F.lit("opened").alias("outcome"))
    rows = rows.union(events.where("closed IS NOT NULL").select("station", "closed", "event_no", F.lit("closed")))
    return rows.union(rejected.select("station", "closed", "event_no", F.lit("rejected")))


HOURLY = """, hx AS (SELECT station, date_trunc('hour', ts) AS hour, arg_max(value, ts) FILTER (WHERE data_type = 'water_level') AS level, avg(value) FILTER (WHERE data_type = 'temperature') AS temperature, count(*) AS n_readings FROM telemetry_long GROUP BY 1, 2)
, sp AS (SELECT station, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour FROM (SELECT station, min(hour) AS a, max(hour) AS b FROM hx GROUP BY 1))
, hourly AS (SELECT sp.station, sp.hour, level, temperature, coalesce(n_readings, 0) AS n_readings, coalesce(n_readings, 0) = 0 AS is_gap FROM sp LEFT JOIN hx USING (station, hour))"""


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = view(spark, sf_dir, "telemetry_long")
    x = x.withColumns({"level": F.when(F.col("data_type") == "water_level", F.col("value")), "temperature": F.when(F.col("data_type") == "temperature", F.col("value"))})
    return telemetry.hourly_resample(x, ["station"], "ts", ["level"], ["temperature"])


@register("a1_hourly_resample", sql("telemetry_long", HOURLY + f"SELECT station, {tm('hour', 'hour')}, {rd('level', 'level')}, {rd('temperature', 'temperature')}, n_readings, is_gap FROM hourly"))
def a1_hourly_resample(spark, sf_dir):
    return tidy(hourly(spark, sf_dir))


@register("a2_daily_telemetry", sql("telemetry_long", MARKS + f"SELECT station, {dt('date', 'date')}, {rd('level_msl', 'level_msl')}, {rd('rain_24h_mm', 'rain_24h_mm')}, hours_covered, hours_covered = 24 AND level_msl IS NOT NULL AS data_complete FROM daily"))
def a2_daily_telemetry(spark, sf_dir):
    return tidy(telemetry.daily_telemetry(hour_marks(spark, sf_dir), ["station"]))


SPILL = """, spine AS (SELECT station, date, CAST(date AS TIMESTAMP) - INTERVAL 16 HOUR + to_hours(CAST(h AS INTEGER)) AS mark FROM (SELECT DISTINCT station, date FROM daily) CROSS JOIN range(24) t(h))
, fh AS (SELECT s.station, s.date, s.mark, last_value(m.level IGNORE NULLS) OVER (PARTITION BY s.station, s.date ORDER BY s.mark ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level FROM spine s LEFT JOIN marks m ON s.station = m.station AND s.mark = m.mark)
, spill AS (SELECT station, date, sum(1.82e0 * 30 * pow(greatest(0e0, level - 0.155e0 - 489.545e0), 1.5e0) * 3600) AS spill_m3, count(*) AS hours_filled FROM fh WHERE level IS NOT NULL GROUP BY 1, 2)"""


def spill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.spill_daily(telemetry.filled_hours(hour_marks(spark, sf_dir), ["station"]), ["station"])


@register("a3_spill_daily", sql("telemetry_long", MARKS + SPILL + f"SELECT station, {dt('date', 'date')}, {rd('spill_m3', 'spill_m3')}, hours_filled FROM spill"))
def a3_spill_daily(spark, sf_dir):
    return tidy(spill(spark, sf_dir))


BALANCE = ", bal AS (" + f"""
 SELECT *, greatest(0e0, inflow_raw_m3) AS inflow_m3 FROM (SELECT *, delta_s_m3 - rain_m3 + release_m3 + spill_m3 + evap_m3 + infiltration_m3 AS inflow_raw_m3 FROM (
 SELECT x.station, x.date, level_msl, rain_24h_mm, storage_m3, prev_storage_m3, coalesce(s.spill_m3, 0e0) AS spill_m3, coalesce(r.release_m3, 0e0) AS release_m3, storage_m3 - prev_storage_m3 AS delta_s_m3,
   area_m2 * rain_24h_mm / 1000 AS rain_m3, area_m2 * ([{', '.join(map(repr, S.EVAPORATION_NORMS))}][month(x.date)] / day(last_day(x.date)) * 0.7e0) / 1000 AS evap_m3, area_m2 / 1000 AS infiltration_m3
 FROM (SELECT *, CASE WHEN lag(date) OVER w = date - 1 THEN lag(storage_m3) OVER w END AS prev_storage_m3 FROM (
   SELECT k.station, k.date, k.level_msl, k.rain_24h_mm, coalesce(c.area_m2, f.area_m2) AS area_m2, coalesce(c.storage_m3, f.storage_m3) AS storage_m3
   FROM (SELECT *, level_msl + 1e-9 AS z FROM dailyf WHERE level_msl IS NOT NULL) k ASOF LEFT JOIN rating_curve c ON k.station = c.station AND k.z >= c.level
   LEFT JOIN (SELECT station, arg_min(area_m2, level) AS area_m2, arg_min(storage_m3, level) AS storage_m3 FROM rating_curve GROUP BY 1) f ON f.station = k.station) WINDOW w AS (PARTITION BY station ORDER BY date)) x
 LEFT JOIN spill s ON s.station = x.station AND s.date = x.date LEFT JOIN (SELECT station, date, sum(rate_m3_per_day) AS release_m3 FROM cov GROUP BY 1, 2) r ON r.station = x.station AND r.date = x.date
 WHERE prev_storage_m3 IS NOT NULL)))"""
PARTS = ("level_msl", "rain_24h_mm", "storage_m3", "delta_s_m3", "rain_m3", "release_m3", "spill_m3", "evap_m3", "infiltration_m3", "inflow_raw_m3", "inflow_m3")


def balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = hour_marks(spark, sf_dir)
    daily = telemetry.daily_telemetry(marks, ["station"], fill=True)
    spilled = telemetry.spill_daily(telemetry.filled_hours(marks, ["station"]), ["station"])
    return telemetry.water_balance_daily(daily, view(spark, sf_dir, "rating_curve"), spilled, releases(spark, sf_dir).select("station", "date", "release_m3"))


@register("a4_water_balance_daily", sql("telemetry_long rating_curve release_events", MARKS + SPILL + COVER + BALANCE + f"SELECT station, {dt('date', 'date')}, {', '.join(rd(c, c, 3) for c in PARTS)} FROM bal"))
def a4_water_balance_daily(spark, sf_dir):
    return tidy(balance(spark, sf_dir).select("station", "date", *PARTS), 3)


@register("w6_locf", sql("telemetry_long", HOURLY + f"SELECT * FROM (SELECT station, {tm('hour', 'hour')}, {rd('last_value(level IGNORE NULLS) OVER (PARTITION BY station ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'level')} FROM hourly) WHERE level IS NOT NULL"))
def w6_locf(spark, sf_dir):
    return tidy(telemetry.locf(hourly(spark, sf_dir), ["station"], "hour", "level").select("station", "hour", "level"))


MONO = ", mono AS (SELECT *, prev IS NULL OR measure_datetime > prev AS stored, (epoch_us(measure_datetime) - epoch_us(prev)) / 3.6e9 AS gap_hours FROM (SELECT *, max(measure_datetime) OVER (PARTITION BY station ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM arrivals))"
GAPS = f"station, row_id, stored, {rd('gap_hours', 'gap_hours')}, coalesce(stored AND gap_hours > 1, FALSE) AS gap_flag"


@register("w13_accept_monotonic", sql("arrivals", MONO + f"SELECT {GAPS} FROM mono"))
def w13_accept_monotonic(spark, sf_dir):
    x = telemetry.accept_monotonic(view(spark, sf_dir, "arrivals"), ["station"], "row_id", "measure_datetime")
    return tidy(x.select("station", "row_id", "stored", "gap_hours", "gap_flag"))


@register("p19_gap_flag", sql("arrivals", MONO + "SELECT station, count(*) FILTER (WHERE stored AND gap_hours > 1) AS gaps, count(*) FILTER (WHERE NOT stored) AS late FROM mono GROUP BY 1"))
def p19_gap_flag(spark, sf_dir):
    x = telemetry.accept_monotonic(view(spark, sf_dir, "arrivals"), ["station"], "row_id", "measure_datetime")
    return x.groupBy("station").agg(F.count_if(F.col("stored") & S.gap_flag("gap_hours")).alias("gaps"), F.count_if(~F.col("stored")).alias("late"))


@register("w14_station_history", sql("telemetry_long", MARKS + f"SELECT station, {tm('mark', 't')}, {rd('value', 'level')} FROM best JOIN (SELECT station, date_trunc('hour', max(ts)) AS fin FROM telemetry_long WHERE data_type = 'water_level' GROUP BY 1) USING (station) WHERE data_type = 'water_level' AND mark <= fin AND mark > fin - INTERVAL 72 HOUR"))
def w14_station_history(spark, sf_dir):
    x = telemetry.station_history(levels(spark, sf_dir), "station", "ts", ["level"], 72)
    return tidy(x.select("station", F.col("mark").alias("t"), "level"))


LATEST = ", latest AS (SELECT station, data_type, arg_max(value, row_id) AS value, arg_max(ts, row_id) AS ts FROM telemetry_long GROUP BY 1, 2)"


@register("a40_latest_per_station", sql("telemetry_long", LATEST + f"SELECT station, data_type, {rd('value', 'value')}, {tm('ts', 'ts')} FROM latest"))
def a40_latest_per_station(spark, sf_dir):
    return tidy(telemetry.latest_per_station(view(spark, sf_dir, "telemetry_long"), ["station"], "data_type", "row_id", "ts", "value"))


SNAP = """, e AS (SELECT station, min(level) AS a, max(level) AS b FROM rating_curve GROUP BY 1)
, c AS (SELECT *, lead(level) OVER w AS hi, lead(storage_m3) OVER w AS s2 FROM rating_curve WINDOW w AS (PARTITION BY station ORDER BY level))
, q AS (SELECT station, value AS level, 'now' AS k, value AS raw FROM latest WHERE data_type = 'water_level' UNION ALL SELECT station, 489.545e0, 'full', NULL FROM latest WHERE data_type = 'water_level')
, p AS (SELECT q.station, q.k, q.raw, greatest(least(q.level, e.b), e.a) AS x, least(greatest(q.level + 1e-9, e.a), e.b) AS z FROM q JOIN e USING (station))
, st AS (SELECT p.station, p.k, p.raw, CASE WHEN c.hi IS NULL THEN c.storage_m3 ELSE c.storage_m3 + (p.x - c.level) / (c.hi - c.level) * (c.s2 - c.storage_m3) END AS s FROM p ASOF JOIN c ON p.station = c.station AND p.z >= c.level)
, snap AS (SELECT station, max(raw) AS level, max(CASE WHEN k = 'now' THEN s END) AS storage_now, max(CASE WHEN k = 'full' THEN s END) AS storage_full FROM st GROUP BY 1)"""


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = telemetry.latest_per_station(view(spark, sf_dir, "telemetry_long"), ["station"], "data_type", "row_id", "ts", "value")
    now = latest.where("data_type = 'water_level'").select("station", F.col("value").alias("level"))
    return telemetry.station_snapshot(now, view(spark, sf_dir, "rating_curve"), S.CREST)


@register("a41_station_snapshot", sql("telemetry_long rating_curve", LATEST + SNAP + f"SELECT station, {rd('level', 'level')}, {rd('storage_now', 'storage_now', 2)}, {rd('storage_full', 'storage_full', 2)}, {rd('489.545e0 - level', 'to_spillway', 3)}, {rd('100 * storage_now / storage_full', 'pct_full', 2)} FROM snap"))
def a41_station_snapshot(spark, sf_dir):
    x = snapshot(spark, sf_dir)
    return x.select("station", F.round("level", 4).alias("level"), "to_spillway", "pct_full", F.round("storage_now", 2).alias("storage_now"), F.round("storage_full", 2).alias("storage_full"))


@register("s13_monitoring_document", sql("telemetry_long rating_curve", MARKS + LATEST + SNAP + """, hist AS (SELECT station, count(*) AS n_history, min(value) AS least FROM best JOIN (SELECT station, date_trunc('hour', max(ts)) AS fin FROM telemetry_long WHERE data_type = 'water_level' GROUP BY 1) USING (station) WHERE data_type = 'water_level' AND mark <= fin AND mark > fin - INTERVAL 72 HOUR GROUP BY 1)
 SELECT s.station, """ + rd("snap.storage_now", "storage_now", 2) + ", coalesce(n_history, 0) AS n_history, " + rd("least", "least_level") + " FROM (SELECT unnest(['RES000','RES001','RES002','RES003','RES004']) AS station) s LEFT JOIN snap USING (station) LEFT JOIN hist USING (station)"))
def s13_monitoring_document(spark, sf_dir):
    history = telemetry.station_history(levels(spark, sf_dir), "station", "ts", ["level"], 72).select("station", F.col("mark").alias("t"), "level")
    static = spark.createDataFrame([(s,) for s in (*STATIONS, "RES004")], "station string")
    doc = readers.monitoring_document(snapshot(spark, sf_dir), history, static)
    flat = doc.select("station", F.round("storage_now", 2).alias("storage_now"), F.coalesce(F.size("history"), F.lit(0)).cast("long").alias("n_history"), F.array_min(F.transform("history", lambda h: h["level"])).alias("least_level"))
    return tidy(flat.withColumn("n_history", F.greatest("n_history", F.lit(0).cast("long"))))


@register("d1_fill_or_flag_gap", sql("telemetry_long", HOURLY + f"""
, rn AS (SELECT station, date_trunc('hour', ts) AS hour, arg_max(value, ts) AS rain FROM telemetry_long WHERE data_type = 'rainfall_1h' AND value IS NOT NULL GROUP BY 1, 2)
, n AS (SELECT h.station, h.hour, level, coalesce(rain, 0e0) AS rain, CAST(h.hour + INTERVAL 16 HOUR AS DATE) AS day, row_number() OVER (PARTITION BY h.station ORDER BY h.hour) AS k FROM hourly h LEFT JOIN rn ON rn.station = h.station AND rn.hour = h.hour)
, kn AS (SELECT * FROM n WHERE level IS NOT NULL)
, f AS (SELECT n.*, a.level AS la, a.k AS i, b.level AS lb, b.k AS j FROM n LEFT JOIN (SELECT *, lead(k) OVER w AS nk FROM kn WINDOW w AS (PARTITION BY station ORDER BY k)) a ON a.station = n.station AND n.k >= a.k AND n.k < coalesce(a.nk, 1000000000000)
    LEFT JOIN (SELECT *, lag(k) OVER w AS pk FROM kn WINDOW w AS (PARTITION BY station ORDER BY k)) b ON b.station = n.station AND n.k <= b.k AND n.k > coalesce(b.pk, 0))
, g AS (SELECT f.*, (SELECT max(rain) FROM n w WHERE w.station = f.station AND w.k BETWEEN f.i AND f.j) AS wet FROM f WHERE level IS NULL)
, bad AS (SELECT DISTINCT station, day FROM g WHERE NOT coalesce(j - i - 1 <= 2 AND wet <= 100, FALSE))
SELECT f.station, {tm('f.hour', 'hour')}, {rd('CASE WHEN bad.day IS NOT NULL THEN NULL WHEN level IS NOT NULL THEN level ELSE la + (k - i) * 1e0 / (j - i) * (lb - la) END', 'filled')},
 level IS NULL AND bad.day IS NULL AS interpolated, bad.day IS NOT NULL AS data_gap_day, CASE WHEN bad.day IS NOT NULL THEN 'data_gap_day' WHEN level IS NULL THEN 'interpolated' ELSE 'ok' END AS gap_status
FROM f LEFT JOIN bad ON bad.station = f.station AND bad.day = f.day"""))
def d1_fill_or_flag_gap(spark, sf_dir):
    x = view(spark, sf_dir, "telemetry_long")
    x = x.withColumns({"level": F.when(F.col("data_type") == "water_level", F.col("value")), "rain": F.when(F.col("data_type") == "rainfall_1h", F.col("value"))})
    hours = telemetry.hourly_resample(x, ["station"], "ts", ["level", "rain"], [])
    out = telemetry.fill_or_flag_gap(hours, ["station"], "hour", "level", rain="rain", rain_limit=100.0, day=telemetry.day_of_mark("hour"))
    return tidy(out.select("station", "hour", "filled", "interpolated", "data_gap_day", "gap_status"))


@register("a20_recursive_api", sql("telemetry_long", MARKS + f"""
, r AS (SELECT station, date, CASE WHEN hours_covered >= 3 THEN sqrt(rain_24h_mm) END AS rain FROM daily)
, k AS (SELECT station, date, rain, row_number() OVER (PARTITION BY station ORDER BY date) AS i FROM r WHERE rain IS NOT NULL)
, p AS (SELECT a.station, a.date, sum(pow(0.95e0, a.i - b.i) * b.rain) AS api FROM k a JOIN k b ON a.station = b.station AND b.i <= a.i GROUP BY 1, 2)
SELECT r.station, {dt('r.date', 'date')}, {rd('p.api', 'api')} FROM r LEFT JOIN p ON r.station = p.station AND r.date = p.date"""))
def a20_recursive_api(spark, sf_dir):
    d = telemetry.daily_telemetry(hour_marks(spark, sf_dir), ["station"]).withColumn("rain", F.when(F.col("hours_covered") >= 3, F.sqrt("rain_24h_mm")))
    return tidy(series.recursive_api(d, ["station"], "date", "rain").select("station", "date", "api"))
