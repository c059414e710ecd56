"""What queries share: tidy output columns, and SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolake.sources import views


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded (no negative zero), times and dates as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def sql(names: str, body: str) -> str:
    """``body`` with the named views before it; more common tables may be given in the body as ', x AS (...) SELECT'."""
    body = body.strip()
    head = views.sql(*names.split())
    return f"WITH {head} {body}" if not body.startswith(",") else f"WITH {head}{body}"


def rd(expr: str, name: str, digits: int = 4) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0e0 AS {name}"


def tm(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}"


def dt(expr: str, name: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR) AS {name}"


LEVELS = ", lv AS (SELECT station, ts, value AS level, row_id FROM telemetry_long WHERE data_type = 'water_level')"

#: nearest reading per hour mark, for one field at a time
MARKS = """
, cand AS (
  SELECT station, data_type, mark, abs(epoch_us(ts) - epoch_us(mark)) AS d, ts, value FROM (
    SELECT *, unnest([date_trunc('hour', ts), date_trunc('hour', ts) + INTERVAL 1 HOUR]) AS mark FROM telemetry_long WHERE data_type IN ('water_level', 'rainfall_1h'))
  WHERE abs(epoch_us(ts) - epoch_us(mark)) <= 1800000000)
, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station, data_type, mark ORDER BY d, ts, value) AS k FROM cand) WHERE k = 1)
, marks AS (SELECT station, mark, max(CASE WHEN data_type = 'water_level' THEN value END) AS level, max(CASE WHEN data_type = 'rainfall_1h' THEN value END) AS rain FROM best GROUP BY 1, 2)
, daily AS (SELECT station, CAST(mark + INTERVAL 16 HOUR AS DATE) AS date, max(CASE WHEN hour(mark) = 7 THEN level END) AS level_msl, sum(coalesce(rain, 0e0)) AS rain_24h_mm, count(*) AS hours_covered FROM marks GROUP BY 1, 2)
, dailyf AS (SELECT station, CAST(mark + INTERVAL 16 HOUR AS DATE) AS date, coalesce(max(CASE WHEN hour(mark) = 7 THEN level END), arg_max(level, mark) FILTER (WHERE level IS NOT NULL)) AS level_msl, sum(coalesce(rain, 0e0)) AS rain_24h_mm FROM marks GROUP BY 1, 2)
"""

#: weekly rain and weather
WEEKLY = """
, wr AS (SELECT zone, CAST(isoyear(date) AS INT) AS iso_year, CAST(week(date) AS INT) AS iso_week, sum(precipitation) AS rain, count(*) AS n_days,
         CASE WHEN max(CASE data_type WHEN 'prelim' THEN 3 WHEN 'prelim_ftp' THEN 2 ELSE 1 END) = 1 THEN 'final' WHEN max(CASE data_type WHEN 'prelim' THEN 3 WHEN 'prelim_ftp' THEN 2 ELSE 1 END) = 2 THEN 'prelim_ftp' ELSE 'prelim' END AS data_type
         FROM rain_daily GROUP BY 1, 2, 3)
, wd AS (SELECT *, t2m - 273.15 AS t, 0.6108e0 * exp(17.27e0 * (t2m - 273.15) / (t2m - 273.15 + 237.3)) AS es, 0.6108e0 * exp(17.27e0 * (d2m - 273.15) / (d2m - 273.15 + 237.3)) AS ea FROM weather_daily)
, we AS (SELECT *, (0.408e0 * (4098 * es / pow(t + 237.3, 2)) * (0.77e0 * ssr / 1e6 + str / 1e6) + g * 900 / (t + 273) * u * (es - ea)) / ((4098 * es / pow(t + 237.3, 2)) + g * (1 + 0.34e0 * u)) AS et0,
         greatest(0e0, es - ea) AS vpd, least(100e0, 100 * ea / es) AS rh
         FROM (SELECT *, 0.000665e0 * (101.3e0 * pow((293 - 0.0065e0 * 300) / 293, 5.26e0)) AS g, sqrt(u10 * u10 + v10 * v10) * 4.87e0 / ln(67.8e0 * 10 - 5.42e0) AS u FROM wd))
, ww AS (SELECT zone, CAST(isoyear(date) AS INT) AS iso_year, CAST(week(date) AS INT) AS iso_week, sum(et0) AS et0, avg(vpd) AS vpd, avg(t) AS t_mean, count(*) AS n_days FROM we GROUP BY 1, 2, 3 HAVING count(*) = 7)
"""
