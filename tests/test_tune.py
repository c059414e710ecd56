"""Tuning holds each row once, not once per fold, and judges the folds of series.ts_folds."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from hydrolake.operators import models, series


def test_folds_are_cut_without_copies(spark, monkeypatch):
    df = spark.range(400).select(F.col("id").alias("row_id"), (F.col("id") % 9 * 1.0).alias("a"), (F.col("id") % 9 * F.col("id") * 1.0).alias("y"))
    x = VectorAssembler(inputCols=["a"], outputCol="_x").transform(series.ts_folds(df, [], "row_id", 3)).cache()
    errors = []
    for fold in (1, 2, 3):
        part = x.where(F.col("fold") == fold)
        model = RandomForestRegressor(featuresCol="_x", labelCol="y", numTrees=8, maxDepth=2, seed=7).fit(part.where("role = 'train'"))
        errors.append(RegressionEvaluator(labelCol="y", metricName="rmse").evaluate(model.transform(part.where("role = 'test'"))))
    monkeypatch.setattr(series, "ts_folds", None)
    found = models.tune(df, ["a"], "y", "row_id", depths=(2,)).first()
    assert found.rmse == pytest.approx(sum(errors) / 3, rel=0.05)  # partitions, and so the forests' samples, may differ
