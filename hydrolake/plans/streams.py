"""Queries: streaming operators run over what is there, with their batch twins' SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake.plans.helpers import MARKS, dt, rd, sql, tidy, tm
from hydrolake.plans.registry import register
from hydrolake.plans.telemetry import LATEST, MONO, PAIRS
from hydrolake.sources.shared import fresh_path
from hydrolake.sources.views import VIEWS
from hydrolake.streaming import streams


def folder(spark, name: str) -> str:
    return fresh_path(spark, f"stream-{name}")


def clock(spark, name: str) -> str:
    return streams.clock_folder(spark, fresh_path(spark, f"clock-{name}"))


def source(spark, sf_dir, name: str):
    v = VIEWS[name]
    x = streams.stream_ingest(spark, f"{sf_dir}/{v.source}.parquet")
    if v.where:
        x = x.where(v.where if isinstance(v.where, str) else v.where[0])
    return x.selectExpr(*[f"{e if isinstance(e, str) else e[0]} AS `{c}`" for c, e in v.columns.items()])


@register("t1_stream_ingest", sql("telemetry_long", f"SELECT row_id, station, data_type, {rd('value', 'value')} FROM telemetry_long"))
def t1_stream_ingest(spark, sf_dir):
    x = source(spark, sf_dir, "telemetry_long").select("row_id", "station", "data_type", "value")
    return tidy(streams.run_to_table(x, folder(spark, "t1")))


@register("t2_stream_monotonic_gap", sql("arrivals", MONO + f"SELECT station, row_id, stored, {rd('gap_hours', 'gap_hours')}, coalesce(stored AND gap_hours > 1, FALSE) AS gap_flag FROM mono"))
def t2_stream_monotonic_gap(spark, sf_dir):
    x = streams.stream_monotonic_gap(source(spark, sf_dir, "arrivals"), "station", "row_id", "measure_datetime")
    history, anomalies = streams.run_split(x, folder(spark, "t2"), "NOT stored OR gap_flag")
    return tidy(history.unionByName(anomalies).withColumnRenamed("key", "station"))


@register("t3_stream_hourly", sql("telemetry_long", f", h AS (SELECT station, date_trunc('hour', ts) AS h, arg_max(value, ts) AS l, avg(value) AS m, count(*) AS n FROM telemetry_long WHERE data_type = 'water_level' GROUP BY 1, 2) SELECT station, {tm('h', 'hour')}, {rd('l', 'last')}, {rd('m', 'mean')}, n FROM h"))
def t3_stream_hourly(spark, sf_dir):
    x = streams.stream_hourly(source(spark, sf_dir, "telemetry_long").where("data_type = 'water_level'"), ["station"], "ts", "value", clock=(end := clock(spark, "t3")))
    return tidy(streams.run_to_table(x, folder(spark, "t3"), clock=end))


@register("t4_stream_latest", sql("telemetry_long", LATEST + f"SELECT station, data_type, {rd('value', 'value')}, {tm('ts', 'ts')} FROM latest"))
def t4_stream_latest(spark, sf_dir):
    x = streams.stream_latest(source(spark, sf_dir, "telemetry_long"), ["station", "data_type"], "row_id", "ts", "value")
    return tidy(streams.run_upserts(x, folder(spark, "t4"), ["station", "data_type"], "row_id").drop("row_id"))


@register("t5_stream_daily_rain", sql("telemetry_long", MARKS + f"""
, r AS (SELECT station, CAST(mark + INTERVAL 16 HOUR AS DATE) AS d, sum(coalesce(value, 0)) AS rain_24h_mm, count(*) AS hours_covered FROM best WHERE data_type = 'rainfall_1h' GROUP BY 1, 2)
SELECT station, {dt('d', 'date')}, {rd('rain_24h_mm', 'rain_24h_mm')}, hours_covered FROM r"""))
def t5_stream_daily_rain(spark, sf_dir):
    x = streams.stream_daily_rain(source(spark, sf_dir, "telemetry_long").where("data_type = 'rainfall_1h'"), ["station"], "ts", "value", clock=(end := clock(spark, "t5")))
    return tidy(streams.run_to_table(x, folder(spark, "t5"), clock=end))


@register("t6_stream_valve_pairing", f"WITH {PAIRS[2:]} SELECT station, row_id, event_no, outcome FROM outcome")
def t6_stream_valve_pairing(spark, sf_dir):
    e = streams.stream_ingest(spark, f"{sf_dir}/events.parquet").where("event_type = 'signup'")
    forms = e.selectExpr("concat('RES00', CAST(user_id % 4 AS STRING)) AS station", "CASE WHEN event_id % 3 = 0 THEN 'open' ELSE 'close' END AS kind", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 1 + event_id % 40 END AS event_no", "event_id AS row_id")
    x = streams.stream_valve_pairing(forms, "station", "row_id")
    return streams.run_to_table(x, folder(spark, "t6"), keyed=True).withColumnRenamed("key", "station")


@register("t7_stream_upsert", sql("arrivals", f"SELECT station, {dt('d', 'day')}, {rd('arg_max(water_level, row_id)', 'water_level')}, max(row_id) AS row_id FROM (SELECT *, CAST(measure_datetime AS DATE) AS d FROM arrivals) GROUP BY 1, d"))
def t7_stream_upsert(spark, sf_dir):
    x = source(spark, sf_dir, "arrivals").select("station", F.to_date("measure_datetime").alias("day"), "water_level", "row_id")
    return tidy(streams.run_upserts(x, folder(spark, "t7"), ["station", "day"], "row_id", mode="append"))


@register("t8_stream_rolling_rain", f"WITH r AS (SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'B' END AS zone, CAST(l_shipdate AS DATE) AS date, l_quantity AS p FROM lineitem), x AS (SELECT zone, p, date + CAST(unnest([0, 1, 2, 3, 4, 5, 6]) AS INTEGER) AS last_day FROM r) SELECT zone, {dt('last_day', 'last_day')}, {rd('sum(p)', 'rain')}, count(*) AS n_days FROM x GROUP BY 1, last_day")
def t8_stream_rolling_rain(spark, sf_dir):
    li = streams.stream_ingest(spark, f"{sf_dir}/lineitem.parquet", files_per_trigger=1 << 20)  # its dates are in no order
    daily = li.select(F.when(F.col("l_suppkey") % 2 == 0, "A").otherwise("B").alias("zone"), F.to_date("l_shipdate").alias("date"), F.col("l_quantity").alias("precipitation"))
    end = clock(spark, "t8")
    return tidy(streams.run_to_table(streams.stream_rolling_rain(daily, ["zone"], clock=end), folder(spark, "t8"), clock=end))
