"""Crop-water demand, crop calendars, areas and parcels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolake.functions import scalar as S

#: Growth stages (crop, stage, first week, last week, crop coefficient), in the order that they are tried; a
#: first week after the last runs over the year's end.
STAGES = (
    ("rice", "GS0", 24, 26, 0.00),
    ("rice", "GS1", 26, 30, 1.15),
    ("rice", "GS2", 30, 38, 1.20),
    ("rice", "GS3", 38, 45, 1.05),
    ("rice", "GS4", 45, 49, 0.00),
    ("corn", "GS0", 22, 25, 0.00),
    ("corn", "GS1", 25, 28, 0.30),
    ("corn", "GS2", 28, 34, 1.20),
    ("corn", "GS3", 34, 39, 0.35),
    ("corn", "GS4", 39, 42, 0.00),
    ("cassava", "GS0", 15, 17, 0.00),
    ("cassava", "GS1", 17, 23, 0.30),
    ("cassava", "GS2", 23, 36, 0.80),
    ("cassava", "GS3", 36, 52, 1.10),
    ("cassava", "GS4", 1, 7, 1.00),
    ("longan", "GS1", 9, 16, 0.70),
    ("longan", "GS2", 16, 42, 0.85),
    ("longan", "GS2_stress", 44, 50, 0.00),
    ("longan", "GS3", 50, 52, 0.90),
    ("longan", "GS4", 1, 8, 0.95),
    ("rubber", "GS_defoliation", 1, 8, 0.60),
    ("rubber", "GS_leaf_flush", 9, 16, 0.80),
    ("rubber", "GS_mature", 16, 52, 1.00),
)


def raised(kc: float, raise_by: float = 1.05) -> float:
    """A coefficient under local conditions: three decimals of the double's exact value, which SQL's round doesn't give."""
    return round(kc * raise_by, 3)


def kc_week_table(spark: SparkSession, stages: Sequence[tuple] = STAGES, raise_by: float = 1.05) -> DataFrame:
    """Per crop and week 1-52 the first stage that holds it, else offseason with coefficient 0."""
    rows = [(i, crop, stage, first, last, raised(kc, raise_by)) for i, (crop, stage, first, last, kc) in enumerate(stages)]
    table = spark.createDataFrame(rows, "pos int, crop string, stage string, first int, last int, kc double")
    weeks = table.select("crop").distinct().withColumn("week", F.explode(F.sequence(F.lit(1), F.lit(52))))
    inside = F.when(F.col("first") <= F.col("last"), F.col("week").between(F.col("first"), F.col("last"))).otherwise((F.col("week") >= F.col("first")) | (F.col("week") <= F.col("last")))
    met = weeks.join(table, "crop").where(inside).groupBy("crop", "week").agg(F.min_by(F.struct("stage", "kc"), "pos").alias("x"))
    out = weeks.join(met, ["crop", "week"], "left")
    return out.select("crop", "week", F.coalesce("x.stage", F.lit("offseason")).alias("stage"), F.coalesce("x.kc", F.lit(0.0)).alias("kc"))


def stage_summary(kc: DataFrame) -> DataFrame:
    """Weeks and approximate months of each stage."""
    month = lambda w: F.month(S.week_start(F.lit(2021), w))
    out = kc.groupBy("crop", "stage").agg(F.min("week").alias("first_week"), F.max("week").alias("last_week"), F.count(F.lit(1)).alias("n_weeks"), F.max("kc").alias("kc"))
    return out.withColumns({"first_month": month(F.col("first_week")), "last_month": month(F.col("last_week"))})


def kc_join(df: DataFrame, kc: DataFrame, missing: str = "zero") -> DataFrame:
    """Coefficients by (crop, week), averaged if the table has years and the rows don't ask for one. missing: zero, drop."""
    on = ["year", "week", "crop"] if "year" in kc.columns and "year" in df.columns else ["week", "crop"]
    table = kc.groupBy(*on).agg(F.avg("kc").alias("kc"))
    if missing == "drop":
        return df.join(table, on)
    return df.join(table, on, "left").withColumn("kc", F.coalesce("kc", F.lit(0.0)))


def crop_demand(climate: DataFrame, kc: DataFrame, area: DataFrame, irrigated: Sequence[str] = ("A",), efficiency: float = 0.9, by: Sequence[str] = ("zone",), skip: Sequence[str] = ("etc",)) -> DataFrame:
    """Cubic metres per key and week: the sum over crops of max(0, Kc * ET0 - rain) * area / 1000; irrigated zones divide
    by the efficiency. Each crop is floored before the sum. Also the crops' own evapotranspiration, and crops without Kc."""
    crops = area.where(~F.col("crop").isin(*skip))
    x = climate.withColumn("week", S.clamp_week("iso_week")).join(crops, "zone").join(kc.groupBy("crop", "week").agg(F.avg("kc").alias("kc")), ["crop", "week"], "left")
    etc = F.col("kc") * F.col("et0")
    own = F.greatest(F.lit(0.0), etc - F.col("p_eff")) * F.col("area_m2") / 1000
    out = x.groupBy(*by, "iso_year", "iso_week").agg(
        F.coalesce(F.sum(own), F.lit(0.0)).alias("net_m3"), F.coalesce(F.sum(etc * F.col("area_m2") / 1000), F.lit(0.0)).alias("etc_m3"),
        F.count_if(F.col("kc").isNull()).alias("crops_without_kc"),
    )
    share = F.when(F.col("zone").isin(*irrigated), F.lit(efficiency)).otherwise(1.0) if "zone" in by else F.lit(efficiency)
    return out.withColumn("gross_m3", F.col("net_m3") / share)


def demand_share(by_area: DataFrame, total_by: Sequence[str], value: str) -> DataFrame:
    """Each sub-area's part of its week's total, 6 decimals; null when the total isn't positive."""
    total = by_area.groupBy(*total_by).agg(F.sum(value).alias("_total"))
    return by_area.join(total, list(total_by)).withColumn("share", F.when(F.col("_total") > 0, F.round(F.col(value) / F.col("_total"), 6))).drop("_total")


def allocate(forecast: DataFrame, shares: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    return forecast.join(shares.select(*on, "sub_area", "share"), list(on)).withColumn("allocated", F.col(value) * F.col("share"))


def class_areas(pixels: DataFrame, by: Sequence[str], klass: str, pixel_m2: float) -> DataFrame:
    """Pixels of each class to m2, ha, km2 and % of the key's valid pixels."""
    n = pixels.where(F.col(klass).isNotNull()).groupBy(*by, klass).agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy(*by).agg(F.sum("n").alias("_all"))
    m2 = F.col("n") * pixel_m2
    return n.join(total, list(by)).withColumns({"m2": m2, "ha": m2 / 1e4, "km2": m2 / 1e6, "pct": F.round(100 * F.col("n") / F.col("_all"), 2)}).drop("_all")


def area_vs_baseline(new: DataFrame, base: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    b = base.select(*on, F.col(value).alias("base"))
    x = new.select(*on, F.col(value).alias("new")).join(b, list(on), "full").withColumns({"new": F.coalesce("new", F.lit(0.0)), "base": F.coalesce("base", F.lit(0.0))})
    return x.withColumn("change_pct", F.when(F.col("base") != 0, F.round(100 * (F.col("new") - F.col("base")) / F.col("base"), 1)))


def growing(parcels: DataFrame) -> DataFrame:
    x = parcels.withColumns({"plant": S.buddhist_date("plant_text"), "harvest": S.buddhist_date("harvest_text")})
    return x.withColumn("days", F.datediff("harvest", "plant"))


def phenology(parcels: DataFrame, by: Sequence[str]) -> DataFrame:
    """Annual crops (30 < days < 365): mean and deviation of planting day, mean harvest day, duration, number and area."""
    x = growing(parcels).where((F.col("days") > 30) & (F.col("days") < 365))
    r = lambda c: F.round(c, 1)
    return x.groupBy(*by).agg(
        r(F.avg(F.dayofyear("plant"))).alias("plant_doy"), r(F.stddev_samp(F.dayofyear("plant"))).alias("plant_doy_std"), r(F.avg(F.dayofyear("harvest"))).alias("harvest_doy"),
        r(F.avg("days")).alias("days"), F.count(F.lit(1)).alias("n"), r(F.sum("area_rai")).alias("area_rai"),
    )


def crop_totals(parcels: DataFrame) -> DataFrame:
    """Number and area by class, and by year and class, in one pass; 1 rai is 1600 m2."""
    x = growing(parcels).withColumn("year", F.year("plant"))
    return x.rollup("crop", "year").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("area_rai") * 1600).alias("area_m2")).where(F.col("crop").isNotNull())


def season_summary(df: DataFrame) -> DataFrame:
    """Means by season and sums by year in one pass over grouping sets."""
    df.createOrReplaceTempView("_season_rows")
    return df.sparkSession.sql(
        """SELECT zone, season, iso_year, avg(et0) AS et0_mean, avg(rain) AS rain_mean, sum(et0) AS et0_sum, sum(rain) AS rain_sum,
                  avg(drought_flag) AS drought_share, CASE WHEN sum(et0) > sum(rain) THEN 'deficit' ELSE 'surplus' END AS status
           FROM _season_rows GROUP BY GROUPING SETS ((zone, season), (zone, iso_year))"""
    )


def pivot(df: DataFrame, index: Sequence[str], column: str, values: Sequence, agg: Column) -> DataFrame:
    return df.groupBy(*index).pivot(column, list(values)).agg(agg)
