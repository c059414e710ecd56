"""One model per key from sufficient statistics: however many keys there are, a fit is an aggregate over the whole table.

Rows never meet in one task: a group's matrices are sums, partial before the shuffle, and only they (the square of the
number of features per group) are solved, group by group, in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolake.sources.shared import fresh_path

LEAST_OF_CLASS = 3


def _solved(rows: DataFrame, by: Sequence[str], more: Sequence[str], solve) -> DataFrame:
    """``solve`` (row to coefficients) over rows of statistics: the keys, the columns ``more``, and coef array<double>."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[[*by, *more]].assign(coef=[solve(r) for r in frame.to_dict("records")])

    kept = [rows.schema[c] for c in (*by, *more)]
    return rows.mapInPandas(run, T.StructType([*kept, T.StructField("coef", T.ArrayType(T.DoubleType()))]))


def fit_linear(train: DataFrame, by: Sequence[str], features: Sequence[str], label: str, ridge: float = 0.0) -> DataFrame:
    """``by``, n, coef (intercept first, then a coefficient per feature) by least squares within each group.

    Rows with a null in a feature or the label are left out. Directions in which a group's features don't vary get the
    coefficient 0 (the solution of least norm); ``ridge`` is added to the features' variances.
    """
    names = list(features)
    rows = train.dropna(subset=[*names, label])
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    stats = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in names], F.avg(label)).alias("_means"),
        F.array(*[F.covar_pop(names[i], names[j]) for i, j in pairs]).alias("_cov"), F.array(*[F.covar_pop(c, label) for c in names]).alias("_with"),
    )

    def solve(r: dict) -> list[float]:
        cov = np.zeros((len(names), len(names)))
        for (i, j), v in zip(pairs, r["_cov"], strict=True):
            cov[i, j] = cov[j, i] = v
        slopes = np.linalg.lstsq(cov + ridge * np.eye(len(names)), np.array(r["_with"]), rcond=1e-12)[0]
        return [float(r["_means"][-1] - slopes @ np.array(r["_means"][:-1])), *slopes.tolist()]

    return _solved(stats, by, ["n"], solve)


def fit_logistic(train: DataFrame, by: Sequence[str], features: Sequence[str], label: str, ridge: float = 1e-3, steps: int = 25, tolerance: float = 1e-9) -> DataFrame:
    """``by``, n_pos, n_neg, coef (intercept first) of P(label = 1), by Newton's method with classes weighed to balance.

    Positives weigh n_neg / n_pos. A group with fewer than three of a class is skipped: its coef is null. Features are
    scaled by their group's mean and deviation while fitting, ``ridge`` (times the weight of the rows) holds coefficients of
    scaled features down, so that separable groups settle. Each step is one aggregate over the table; the
    coefficients are written in between.
    """
    names, keys, spark = list(features), list(by), train.sparkSession
    rows = train.dropna(subset=[*names, label]).select(*keys, *[F.col(c).cast("double").alias(c) for c in names], F.col(label).cast("double").alias("_y"))
    counts = rows.groupBy(*keys).agg(
        F.count_if(F.col("_y") == 1).alias("n_pos"), F.count_if(F.col("_y") == 0).alias("n_neg"),
        F.array(*[F.avg(c) for c in names]).alias("_mean"), F.array(*[F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)) for c in names]).alias("_dev"),
    )
    counts = _written(counts, "logistic-groups")
    fitted = (F.col("n_pos") >= LEAST_OF_CLASS) & (F.col("n_neg") >= LEAST_OF_CLASS)
    width = len(names) + 1
    now = counts.where(fitted).withColumn("coef", F.array(*[F.lit(0.0)] * width)).withColumn("_step", F.lit(1.0))
    scaled = [(F.col(c) - F.col("_mean")[i]) / F.col("_dev")[i] for i, c in enumerate(names)]
    x: list[Column] = [F.lit(1.0), *scaled]
    score = sum((F.col("coef")[i] * x[i] for i in range(1, width)), F.col("coef")[0])
    weight = F.when(F.col("_y") == 1, F.col("n_neg") / F.col("n_pos")).otherwise(1.0)
    pairs = [(i, j) for i in range(width) for j in range(i, width)]

    def solve(r: dict) -> list[float]:
        hessian = np.zeros((width, width))
        for (i, j), v in zip(pairs, r["_h"], strict=True):
            hessian[i, j] = hessian[j, i] = v
        held = ridge * r["_total"] * np.array([0.0, *[1.0] * (width - 1)])
        coef = np.array(r["_coef"])
        return (coef + np.linalg.lstsq(hessian + np.diag(held), np.array(r["_g"]) - held * coef, rcond=1e-12)[0]).tolist()

    for _ in range(steps):
        p = 1 / (1 + F.exp(-score))
        terms = rows.join(now.drop("_step"), keys).select(*keys, "coef", "n_pos", "n_neg", "_mean", "_dev", p.alias("_p"), weight.alias("_w"), "_y", F.array(*x).alias("_x"))
        error, curve = F.col("_w") * (F.col("_y") - F.col("_p")), F.col("_w") * F.col("_p") * (1 - F.col("_p"))
        stats = terms.groupBy(*keys).agg(
            F.first("coef").alias("_coef"), F.sum("_w").alias("_total"), F.array(*[F.sum(error * F.col("_x")[i]) for i in range(width)]).alias("_g"),
            F.array(*[F.sum(curve * F.col("_x")[i] * F.col("_x")[j]) for i, j in pairs]).alias("_h"),
        )
        further = _solved(stats, keys, ["_coef"], solve)
        moved = F.array_max(F.transform(F.arrays_zip("coef", "_coef"), lambda z: F.abs(z["coef"] - z["_coef"])))
        now = _written(further.withColumn("_step", moved).drop("_coef").join(counts, keys), "logistic-step")
        if (now.agg(F.max("_step")).first()[0] or 0.0) < tolerance:
            break
    raw = [F.col("coef")[i + 1] / F.col("_dev")[i] for i in range(len(names))]
    first = F.col("coef")[0] - sum((raw[i] * F.col("_mean")[i] for i in range(len(names))), F.lit(0.0))
    out = now.select(*keys, F.array(first, *raw).alias("coef"))
    return counts.select(*keys, "n_pos", "n_neg").join(out, keys, "left")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def linear_score(coef: str, features: Sequence[str]) -> Column:
    return sum((F.col(coef)[i] * F.col(c) for i, c in enumerate(features, 1)), F.col(coef)[0])


def predict_occurrence(rows: DataFrame, models: DataFrame, by: Sequence[str], features: Sequence[str]) -> DataFrame:
    """``rows`` with p; null for groups without a model."""
    return rows.join(models.select(*by, "coef"), list(by), "left").withColumn("p", 1 / (1 + F.exp(-linear_score("coef", features)))).drop("coef")


def fit_delta(train: DataFrame, by: Sequence[str], features: Sequence[str], label: str, now: str, ridge: float = 0.0) -> DataFrame:
    """Linear fits, per group, of the change from ``now`` to the label on rows with a positive label."""
    return fit_linear(train.where(F.col(label) > 0).withColumn("_delta", F.col(label) - F.col(now)), by, features, "_delta", ridge)


def predict_delta(rows: DataFrame, models: DataFrame, by: Sequence[str], features: Sequence[str], now: str) -> DataFrame:
    """``rows`` with m: ``now`` and the change, at least 0; null for groups without a model."""
    change = linear_score("coef", features)
    return rows.join(models.select(*by, "coef"), list(by), "left").withColumn("m", F.when(F.col("coef").isNotNull(), F.greatest(F.col(now) + change, F.lit(0.0)))).drop("coef")
