"""Queries: pixel tables, zones and stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake.functions import scalar as S
from hydrolake.operators import demand, features, lookups, pixels, series
from hydrolake.plans.climate import RV, weekly_rain
from hydrolake.plans.helpers import WEEKLY, rd, sql, tidy
from hydrolake.plans.registry import register
from hydrolake.sources.views import view

RINGS = {"Z1": [(10, 10), (90, 10), (50, 90)], "Z2": [(100, 20), (180, 20), (180, 80), (100, 80)], "Z3": [(20, 110), (120, 110), (120, 150), (70, 150), (70, 190), (20, 190)]}


def polygons(spark):
    rows = [(k, [(float(x), float(y)) for x, y in ring]) for k, ring in RINGS.items()]
    return spark.createDataFrame(rows, "poly string, ring array<struct<x:double,y:double>>")


def px(spark, sf_dir):
    return view(spark, sf_dir, "pixels")


@register("p9_spectral_indices", sql("pixels", f"SELECT scene, px, py, {rd('max((nir - red) / nullif(nir + red, 0))', 'ndvi')}, {rd('max((green - nir) / nullif(green + nir, 0))', 'ndwi')}, {rd('max((nir - rededge) / nullif(nir + rededge, 0))', 'ndre')}, {rd('max(1.5e0 * (nir - red) / nullif(nir + red + 0.5e0, 0))', 'savi')} FROM pixels GROUP BY 1, 2, 3"))
def p9_spectral_indices(spark, sf_dir):
    x = px(spark, sf_dir).withColumns({"ndvi": S.normalised_difference("nir", "red"), "ndwi": S.normalised_difference("green", "nir"), "ndre": S.normalised_difference("nir", "rededge"), "savi": S.soil_adjusted("nir", "red")})
    return tidy(x.groupBy("scene", "px", "py").agg(*[F.max(c).alias(c) for c in ("ndvi", "ndwi", "ndre", "savi")]))


@register("p10_db_ratio", sql("pixels", f"SELECT scene, px, py, {rd('max(vh - vv)', 'db')}, {rd('max(pow(10e0, vh / 10) / pow(10e0, vv / 10))', 'linear')} FROM pixels WHERE vv > -9999 GROUP BY 1, 2, 3"))
def p10_db_ratio(spark, sf_dir):
    db, linear = S.decibel_ratio("vv", "vh")
    x = px(spark, sf_dir).where("vv > -9999").withColumns({"db": db, "linear": linear})
    return tidy(x.groupBy("scene", "px", "py").agg(F.max("db").alias("db"), F.max("linear").alias("linear")))


@register("p22_impute_sentinel", sql("pixels", f", m AS (SELECT quantile_cont(nullif(vv, -9999), 0.5) AS m FROM pixels) SELECT scene, count(*) AS n, {rd('avg(coalesce(nullif(vv, -9999), m, 0))', 'vv')} FROM pixels, m GROUP BY 1"))
def p22_impute_sentinel(spark, sf_dir):
    return tidy(features.impute_sentinel(px(spark, sf_dir), ["vv"]).groupBy("scene").agg(F.count(F.lit(1)).alias("n"), F.avg("vv").alias("vv")))


@register("j15_extract_at_points", sql("pixels parcels", f", pt AS (SELECT parcel_id, CAST(floor((lon - 99) * 200 / 1e0) AS BIGINT) AS px, CAST(floor((lat - 18) * 200 / 1e0) AS BIGINT) AS py FROM parcels) SELECT parcel_id, CAST(n AS BIGINT) AS n, {rd('s / n', 'green')} FROM pt JOIN (SELECT px, py, count(*) AS n, sum(green) AS s FROM pixels GROUP BY 1, 2) USING (px, py)"))
def j15_extract_at_points(spark, sf_dir):
    points = view(spark, sf_dir, "parcels").select("parcel_id", ((F.col("lon") - 99) * 200).alias("x"), ((F.col("lat") - 18) * 200).alias("y"))
    # one row per pixel before the join: each point meets one row
    bands = px(spark, sf_dir).groupBy("px", "py").agg(F.count(F.lit(1)).alias("n"), F.avg("green").alias("green"))
    return tidy(lookups.pixel_join(points, bands, 0, 0, 1.0).select("parcel_id", "n", "green"))


_EDGES = ", ".join(f"('{k}', {ring[i][0]}e0, {ring[i][1]}e0, {ring[(i + 1) % len(ring)][0]}e0, {ring[(i + 1) % len(ring)][1]}e0)" for k, ring in RINGS.items() for i in range(len(ring)))
INSIDE = f""", ed(poly, ax, ay, bx, b_y) AS (VALUES {_EDGES}), pt AS (SELECT DISTINCT px, py, px + 0.5e0 AS x, py + 0.5e0 AS y FROM pixels)
, ins AS (SELECT poly, px, py FROM pt CROSS JOIN ed WHERE (ay > y) <> (b_y > y) AND x < (bx - ax) * (y - ay) / (b_y - ay) + ax GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)"""


def inside(spark, sf_dir):
    points = px(spark, sf_dir).select("px", "py").distinct().withColumns({"x": F.col("px") + 0.5, "y": F.col("py") + 0.5})
    return lookups.points_in_polygons(points, polygons(spark)).select("poly", "px", "py")


@register("j16_point_in_polygon", sql("pixels", INSIDE + " SELECT poly, px, py FROM ins"))
def j16_point_in_polygon(spark, sf_dir):
    return inside(spark, sf_dir)


AREA = ", n AS (SELECT zone, class_id, count(*) AS n FROM pixels GROUP BY 1, 2)"


@register("a14_zone_crop_area", sql("pixels", AREA + f"SELECT zone, class_id, n, {rd('n * 400e0', 'm2', 2)}, {rd('n * 0.04e0', 'ha', 2)}, {rd('n * 0.0004e0', 'km2', 6)}, {rd('100e0 * n / sum(n) OVER (PARTITION BY zone)', 'pct', 2)} FROM n"))
def a14_zone_crop_area(spark, sf_dir):
    x = demand.class_areas(px(spark, sf_dir), ["zone"], "class_id", 400.0)
    return x.select("zone", "class_id", "n", *[(F.round(c, d) + 0.0).alias(c) for c, d in (("m2", 2), ("ha", 2), ("km2", 6), ("pct", 2))])


@register("a15_area_vs_baseline", sql("pixels", f", a AS (SELECT class_id, count(*) * 400e0 AS v FROM pixels WHERE year(day) >= 1999 GROUP BY 1), b AS (SELECT class_id, count(*) * 400e0 AS v FROM pixels WHERE year(day) < 1999 AND class_id < 4 GROUP BY 1) SELECT class_id, {rd('coalesce(a.v, 0)', 'new')}, {rd('coalesce(b.v, 0)', 'base')}, {rd('CASE WHEN coalesce(b.v, 0) <> 0 THEN 100 * (coalesce(a.v, 0) - b.v) / b.v END', 'change_pct', 1)} FROM a FULL JOIN b USING (class_id)"))
def a15_area_vs_baseline(spark, sf_dir):
    v = lambda d: d.groupBy("class_id").agg((F.count(F.lit(1)) * 400.0).alias("v"))
    x = px(spark, sf_dir)
    return tidy(demand.area_vs_baseline(v(x.where("year(day) >= 1999")), v(x.where("year(day) < 1999 AND class_id < 4")), ["class_id"], "v"))


@register("a36_sar_week_quality", sql("pixels", """
, w AS (SELECT zone, class_id, CAST(year(day) AS INT) AS year, CAST((dayofyear(day) - 1) // 7 AS INT) AS week, count(DISTINCT scene) AS k FROM pixels GROUP BY 1, 2, 3, 4)
, y AS (SELECT zone, class_id, CAST(unnest(generate_series(min(year(day)), max(year(day)))) AS INT) AS year FROM pixels GROUP BY 1, 2)
, f AS (SELECT y.*, t.i AS week, coalesce(k, 0) AS k FROM y CROSS JOIN range(53) t(i) LEFT JOIN w ON w.zone = y.zone AND w.class_id = y.class_id AND w.year = y.year AND w.week = t.i)
SELECT zone, class_id, year, count(*) AS weeks, CAST(sum(k) AS BIGINT) AS images, count(*) FILTER (WHERE k = 0) AS empty, count(*) FILTER (WHERE k = 0 AND week IN (3, 9, 27)) AS match, count(*) FILTER (WHERE k = 0 AND week NOT IN (3, 9, 27)) AS diverge, """ + rd("100e0 * count(*) FILTER (WHERE k = 0) / count(*)", "empty_pct", 2) + " FROM f GROUP BY 1, 2, 3"))
def a36_sar_week_quality(spark, sf_dir):
    return tidy(pixels.week_quality(px(spark, sf_dir), ["zone", "class_id"], "day", [3, 9, 27]), 2)


@register("a37_weekly_composite", sql("pixels", "SELECT zone, class_id, year, " + ", ".join(f"{rd(f'avg(vv) FILTER (WHERE b = {i})', f'w{i}_vv')}, {rd(f'avg(vh) FILTER (WHERE b = {i})', f'w{i}_vh')}" for i in range(pixels.WEEKS)) + " FROM (SELECT *, CAST(year(day) AS INT) AS year, (dayofyear(day) - 1) // 7 AS b FROM pixels WHERE vv > -9999) GROUP BY 1, 2, 3"))
def a37_weekly_composite(spark, sf_dir):
    x = pixels.weekly_composite(px(spark, sf_dir).where("vv > -9999"), ["zone", "class_id"], "day", ["vv", "vh"])
    return tidy(x.select("zone", "class_id", "year", *[F.col(f"{i}_{b}").alias(f"w{i}_{b}") for i in range(pixels.WEEKS) for b in ("vv", "vh")]))


@register("a38_median_composite", sql("pixels", f"SELECT px, {rd('quantile_cont(green, 0.5)', 'green')}, {rd('quantile_cont(nir, 0.5)', 'nir')} FROM pixels WHERE month(day) IN (11, 12, 1, 2, 3, 4) AND cloud < 10 GROUP BY 1"))
def a38_median_composite(spark, sf_dir):
    return tidy(pixels.median_composite(px(spark, sf_dir), ["px"], "day", ["green", "nir"], "cloud", 10))


TEMPLATES = [("A", "low", [0.0, 0.0, 10.0, 20.0]), ("A", "peak", [20.0, 60.0, 60.0, 20.0]), ("B", "low", [5.0, 5.0, 5.0, 5.0]), ("B", "peak", [40.0, 50.0, 40.0, 30.0])]


def rain_windows(spark, sf_dir):
    w = series.sliding_windows(weekly_rain(spark, sf_dir), ["zone"], ["iso_year", "iso_week"], "rain", 4)
    return w.where("NOT no_data").select("zone", "iso_year", "iso_week", "window")


def _dtw_sql() -> str:
    """The 4 x 4 recurrence, one cell per step."""
    steps = []
    for i in range(4):
        cells = []
        for j in range(4):
            before = [f"d{i - 1}{j}" if i else None, f"d{i}{j - 1}" if j else None, f"d{i - 1}{j - 1}" if i and j else None]
            before = [x for x in before if x]
            cells.append((f"d{i}{j}", f"abs(win[{i + 1}] - tpl[{j + 1}])" + (f" + least({', '.join(before)})" if before else "")))
        for name, e in cells:
            steps.append((name, e))
    text = "SELECT *, {} AS {} FROM ({})"
    inner = "SELECT w.*, t.stage, t.tpl FROM win w JOIN tp t USING (zone)"
    for name, e in steps:
        inner = text.format(e, name, inner)
    return inner


_T = ", ".join(f"('{z}', '{s}', [{', '.join(f'{v}e0' for v in t)}])" for z, s, t in TEMPLATES)
DTW = f""", tp(zone, stage, tpl) AS (VALUES {_T}), win AS (SELECT zone, iso_year, iso_week, win FROM (SELECT zone, iso_year, iso_week, count(*) OVER w AS n, list(rain) OVER w AS win FROM wr WINDOW w AS (PARTITION BY zone ORDER BY iso_year, iso_week ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)) WHERE n = 4), dd AS ({_dtw_sql()})"""


def templates(spark):
    return spark.createDataFrame(TEMPLATES, "zone string, stage string, template array<double>")


@register("g4_dtw_pairs", sql(RV, WEEKLY + DTW + f" SELECT zone, iso_year, iso_week, stage, {rd('d33', 'dist')} FROM dd"))
def g4_dtw_pairs(spark, sf_dir):
    return tidy(pixels.dtw_pairs(rain_windows(spark, sf_dir), templates(spark), ["zone"]).select("zone", "iso_year", "iso_week", "stage", "dist"))


@register("g5_classify_stage", sql(RV, WEEKLY + DTW + f" SELECT zone, iso_year, iso_week, arg_min(stage, d33 * 1e6 + CASE stage WHEN 'low' THEN 0 ELSE 1e-7 END) AS stage, {rd('min(d33)', 'dist')} FROM dd GROUP BY 1, 2, 3"))
def g5_classify_stage(spark, sf_dir):
    return tidy(pixels.classify_stage(rain_windows(spark, sf_dir), templates(spark), ["zone", "iso_year", "iso_week"], "zone").drop("window"))


@register("g8_interior_sample", sql("pixels", INSIDE + """
, whole AS (SELECT a.poly, a.px, a.py FROM ins a JOIN (SELECT poly, px + dx AS px, py + dy AS py FROM ins, (VALUES (-1), (0), (1)) x(dx), (VALUES (-1), (0), (1)) y(dy)) b USING (poly, px, py) GROUP BY 1, 2, 3 HAVING count(*) = 9)
SELECT * FROM (SELECT poly, px, py, row_number() OVER (PARTITION BY poly ORDER BY md5(concat(px, ':', py, ':1')), px, py) AS rank FROM whole) WHERE rank <= 50"""))
def g8_interior_sample(spark, sf_dir):
    return pixels.interior_sample(inside(spark, sf_dir), "poly", "px", "py", 50)
