"""Pixel tables: composites, image weeks, stage matching by time warping, samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrolake.operators import ranges


WEEKS = 53  # bins of seven days in a year


def week_of_year(day: str) -> Column:
    return F.floor((F.dayofyear(day) - 1) / 7).cast("int")


def weekly_composite(images: DataFrame, by: Sequence[str], day: str, bands: Sequence[str]) -> DataFrame:
    """Mean of each band per key and year in 7-day bins from 1 January, one column per band and bin; an empty bin is null.

    53 bins: the last one has the year's 365th and 366th day.
    """
    x = images.withColumns({"year": F.year(day), "_bin": week_of_year(day)})
    return x.groupBy(*by, "year").pivot("_bin", list(range(WEEKS))).agg(*[F.avg(b).alias(b) for b in bands])


def median_composite(images: DataFrame, by: Sequence[str], day: str, bands: Sequence[str], cloud: str, most_cloud: float) -> DataFrame:
    """Per-band median over scenes of November to April under a cloud limit."""
    x = images.where(F.month(day).isin(11, 12, 1, 2, 3, 4) & (F.col(cloud) < most_cloud))
    kept = [ranges.exact_quantile(x.select(*by, F.col(b)), by, b, F.lit(0.5), b).drop("n") for b in bands]
    keys = x.select(*by).distinct()
    return reduce(lambda a, b: a.join(b, list(by), "left"), kept, keys)


def week_quality(images: DataFrame, by: Sequence[str], day: str, known_empty: Sequence[int]) -> DataFrame:
    """Images per week of each year from the key's first to its last; empty weeks that match those known from training,
    and those that don't."""
    n = images.withColumns({"year": F.year(day), "week": week_of_year(day)}).groupBy(*by, "year", "week").agg(F.count_distinct("scene").alias("n_images"))
    years = images.groupBy(*by).agg(F.min(F.year(day)).alias("a"), F.max(F.year(day)).alias("b"))
    spine = years.select(*by, F.explode(F.sequence("a", "b")).alias("year")).withColumn("week", F.explode(F.sequence(F.lit(0), F.lit(WEEKS - 1))))
    by = [*by, "year"]
    x = spine.join(n, [*by, "week"], "left").withColumn("n_images", F.coalesce("n_images", F.lit(0).cast("long")))
    empty, known = F.col("n_images") == 0, F.col("week").isin(*known_empty)
    return x.groupBy(*by).agg(
        F.count(F.lit(1)).alias("weeks"), F.sum("n_images").alias("images"), F.count_if(empty).alias("empty"), F.count_if(empty & known).alias("match"),
        F.count_if(empty & ~known).alias("diverge"), F.round(100 * F.count_if(empty) / F.count(F.lit(1)), 2).alias("empty_pct"),
    )


def dtw(a: Column, b: Column, n: int, m: int) -> Column:
    """Time-warping distance of arrays of n and m values, absolute cost.

    Row by row: an outer fold over a keeps the row of least costs, an inner fold over b builds the next one, so the
    expression stays small.
    """
    inf = F.lit(float("inf"))
    first = F.array(F.lit(0.0), *[inf] * m)

    def row(before: Column, i: Column) -> Column:
        cost = lambda j: F.abs(F.get(a, i) - F.get(b, j - 1))
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(m)), F.array(inf),
            lambda acc, j: F.array_append(acc, cost(j) + F.least(F.get(before, j), F.get(before, j - 1), F.get(acc, j - 1))),
        )

    return F.get(F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), first, row), F.lit(m))


def dtw_pairs(windows: DataFrame, templates: DataFrame, on: Sequence[str], n: int = 4) -> DataFrame:
    """A distance per window and template of its crop."""
    return windows.join(templates, list(on)).withColumn("dist", dtw(F.col("window"), F.col("template"), n, n))


def classify_stage(windows: DataFrame, templates: DataFrame, key: Sequence[str], crop: str = "crop") -> DataFrame:
    """The stage of the nearest template (of equals the first name); a crop without templates is unknown."""
    best = dtw_pairs(windows, templates, [crop]).groupBy(*key).agg(F.min(F.struct("dist", "stage")).alias("x"))
    return windows.join(best, list(key), "left").select(*windows.columns, F.coalesce("x.stage", F.lit("unknown")).alias("stage"), F.col("x.dist").alias("dist"))


def interior_sample(pixels: DataFrame, by: str, x: str, y: str, n: int, erosion: int = 1, seed: int = 1) -> DataFrame:
    """Up to n pixels of each region (by hash order) all of whose neighbours within ``erosion`` belong to it."""
    span = F.sequence(F.lit(-erosion), F.lit(erosion))
    near = pixels.select(by, x, y).distinct().withColumn("_dx", F.explode(span)).withColumn("_dy", F.explode(span))
    inside = near.groupBy(by, (F.col(x) + F.col("_dx")).alias(x), (F.col(y) + F.col("_dy")).alias(y)).agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") == (2 * erosion + 1) ** 2)
    own = inside.select(by, x, y).join(pixels.select(by, x, y).distinct(), [by, x, y], "left_semi")
    order, whole = ranges.hashed(x, y, seed)
    ranked = ranges.numbered(own.withColumns({"_o": order, "_h": whole}), [by], "_o", "rank", ["_h", x, y])
    return ranked.where(F.col("rank") <= n).drop("_o", "_h")
