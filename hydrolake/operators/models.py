"""Models on Spark ML: occurrence, magnitude, tuning, stacking, pixel classes, importances."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolake.operators import ranges, series


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def fit_occurrence(train: DataFrame, apply: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = (), trees: int = 20, seed: int = 7) -> DataFrame:
    """P(label) with classes weighed by n_neg / n_pos. Keys are features of one forest over the long table, so the
    fit is one distributed job however many keys there are."""
    counts = train.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    weight = F.when(F.col(label) == 1, counts["n"] / max(1, counts["p"])).otherwise(1.0)
    model = Pipeline(stages=[VectorAssembler(inputCols=[*features, *by], outputCol="_x", handleInvalid="keep"), RandomForestClassifier(featuresCol="_x", labelCol=label, weightCol="_w", numTrees=trees, seed=seed)]).fit(train.withColumn("_w", weight))
    return model.transform(apply).withColumn("p", vector_to_array("probability")[1]).drop("_x", "rawPrediction", "probability", "prediction")


def fit_magnitude(train: DataFrame, apply: DataFrame, features: Sequence[str], label: str, seed: int = 7, kinds: Sequence[str] = ("gbt", "forest", "linear")) -> DataFrame:
    """Regressors on positive rows; one prediction column per kind."""
    makers = {
        "gbt": lambda: GBTRegressor(featuresCol="_x", labelCol=label, maxIter=10, maxDepth=4, seed=seed, predictionCol="m_gbt"),
        "forest": lambda: RandomForestRegressor(featuresCol="_x", labelCol=label, numTrees=15, seed=seed, predictionCol="m_forest"),
        "linear": lambda: LinearRegression(featuresCol="_x", labelCol=label, regParam=0.01, predictionCol="m_linear"),
    }
    to_vector = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="skip")
    model = Pipeline(stages=[to_vector, *[makers[k]() for k in kinds]]).fit(train.where(F.col(label) > 0))
    return model.transform(apply).drop("_x")


def tune(df: DataFrame, features: Sequence[str], label: str, order: str, folds: int = 3, depths: Sequence[int] = (2, 4), seed: int = 7, parallel: int = 3) -> DataFrame:
    """Grid search over expanding time-series folds by RMSE: (maxDepth, rmse) per setting; ``parallel`` fits at a time."""
    n = df.count()
    rows = ranges.numbered(df.select(*dict.fromkeys([*features, label, order])), [], order, "_i")  # each row once: folds are cut by its number, as in series.ts_folds
    x = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="skip").transform(rows).select("_x", label, "_i").cache()
    block, at = n // (folds + 1), F.col("_i")

    def one(setting: tuple[int, int]) -> tuple[int, int, float]:
        depth, fold = setting
        start = n - (folds - fold + 1) * block
        model = RandomForestRegressor(featuresCol="_x", labelCol=label, numTrees=8, maxDepth=depth, seed=seed).fit(x.where(at <= start))
        return depth, fold, float(RegressionEvaluator(labelCol=label, metricName="rmse").evaluate(model.transform(x.where((at > start) & (at <= start + block)))))

    with ThreadPoolExecutor(parallel) as pool:
        out = list(pool.map(one, [(depth, fold) for depth in depths for fold in range(1, folds + 1)]))
    x.unpersist()
    return df.sparkSession.createDataFrame(out, "max_depth int, fold int, rmse double").groupBy("max_depth").agg(F.avg("rmse").alias("rmse"))


def ridge_stack(train: DataFrame, apply: DataFrame, inputs: Sequence[str], label: str, alphas: Sequence[float] = (0.1, 1.0, 10.0), folds: int = 5, seed: int = 7) -> DataFrame:
    """Ridge on the outputs of other models, its strength by cross-validation."""
    ridge = LinearRegression(featuresCol="_x", labelCol=label, elasticNetParam=0.0, predictionCol="stacked")
    grid = ParamGridBuilder().addGrid(ridge.regParam, list(alphas)).build()
    to_vector = VectorAssembler(inputCols=list(inputs), outputCol="_x", handleInvalid="skip")
    cv = CrossValidator(estimator=ridge, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol=label, predictionCol="stacked", metricName="rmse"), numFolds=folds, seed=seed)
    model = cv.fit(to_vector.transform(train))
    return model.transform(to_vector.transform(apply)).drop("_x")


class MacroF1(Evaluator):
    """The mean over classes of F1; a class that is in the labels or the predictions counts once, however rare."""

    def __init__(self, label: str, prediction: str) -> None:
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        return macro_f1(dataset, self.label, self.prediction)

    def isLargerBetter(self) -> bool:
        return True


def f1_by_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """class, support, f1 from the confusion matrix."""
    cells = df.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("z")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("found"), F.when(F.col("y") == F.col("z"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("z").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("found"), F.lit(0).cast("long").alias("hit")),
    )).alias("s")).select("s.*")
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "found", "hit")])
    return sums.select("class", "support", (2 * F.col("hit") / (F.col("support") + F.col("found"))).alias("f1"))


def macro_f1(df: DataFrame, label: str, prediction: str) -> float:
    return float(f1_by_class(df, label, prediction).agg(F.avg("f1")).first()[0] or 0.0)


def pixel_pipeline(bands: Sequence[str], label: str, trees: int = 15, seed: int = 7) -> Pipeline:
    """Medians, min-max, class-balanced forest (weights in _w)."""
    return Pipeline(stages=[
        Imputer(inputCols=list(bands), outputCols=[f"_i_{b}" for b in bands], strategy="median"), VectorAssembler(inputCols=[f"_i_{b}" for b in bands], outputCol="_v"),
        MinMaxScaler(inputCol="_v", outputCol="_x"), RandomForestClassifier(featuresCol="_x", labelCol=label, weightCol="_w", numTrees=trees, seed=seed, predictionCol="klass"),
    ])


def balanced(train: DataFrame, label: str) -> DataFrame:
    """``train`` with _w: each class has the same weight in all."""
    n = train.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    k, total = n.count(), train.count()
    return train.join(n, label).withColumn("_w", F.lit(float(total)) / (k * F.col("_n"))).drop("_n")


def fit_pixel_classifier(train: DataFrame, bands: Sequence[str], label: str, trees: int = 15, seed: int = 7) -> PipelineModel:
    return pixel_pipeline(bands, label, trees, seed).fit(balanced(train, label))


def select_pixel_classifier(
    rows: DataFrame, bands: Sequence[str], label: str, key: str, depths: Sequence[int] = (3, 6), trees: Sequence[int] = (8, 16), folds: int = 5, seed: int = 7, parallel: int = 3,
) -> tuple[PipelineModel, dict, DataFrame]:
    """The classifier with the best macro-F1 in cross-validation, its setting, and F1 per class on rows that it never saw.

    Stratified 80/20: a fifth of each class, by hash order of ``key``, is held out. The rest is dealt to folds per class, and
    each setting of the grid is fitted on all folds but one and judged on that one.
    """
    parts = series.stratified_folds(rows, label, key, 5, seed).withColumnRenamed("fold", "_part")
    train, held = parts.where("_part <> 0").drop("_part"), parts.where("_part = 0").drop("_part")
    x = balanced(series.stratified_folds(train, label, key, folds, seed + 1), label).withColumn("fold", F.col("fold").cast("int")).cache()
    pipeline = pixel_pipeline(bands, label, seed=seed)
    *prepare, forest = pipeline.getStages()
    grid = ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).addGrid(forest.numTrees, list(trees)).build()

    def judged(fold: int) -> list[float]:
        """Macro-F1 of each setting on one fold; what comes before the forest is fitted once for all of them."""
        ready = Pipeline(stages=prepare).fit(x.where(F.col("fold") != fold)).transform(x).select("_x", label, "_w", "fold").cache()
        scores = [macro_f1(forest.copy(g).fit(ready.where(F.col("fold") != fold)).transform(ready.where(F.col("fold") == fold)), label, "klass") for g in grid]
        ready.unpersist()
        return scores

    with ThreadPoolExecutor(parallel) as pool:
        means = np.mean(list(pool.map(judged, range(folds))), axis=0)
    best = int(np.argmax(means))
    model = pipeline.copy(grid[best]).fit(x)
    x.unpersist()
    setting = {"max_depth": grid[best][forest.maxDepth], "trees": grid[best][forest.numTrees], "macro_f1": float(means[best])}
    return model, setting, f1_by_class(model.transform(held), label, "klass")


def classify_pixels(model: PipelineModel, pixels: DataFrame, bands: Sequence[str], valid: str, nodata: int = 255) -> DataFrame:
    """Classes of valid pixels, ``nodata`` elsewhere. The bands must be those the model was fitted on, in their order."""
    fitted = [c.removeprefix("_i_") for c in model.stages[0].getOutputCols()]
    if fitted != list(bands):
        raise ValueError(f"bands {list(bands)} aren't the fitted {fitted}")
    out = model.transform(pixels)
    return out.withColumn("klass", F.when(F.col(valid), F.col("klass")).otherwise(nodata).cast("int")).drop(*[c for c in out.columns if c.startswith("_")], "rawPrediction", "probability")


def feature_importance(model: PipelineModel, names: Sequence[str], spark) -> DataFrame:
    scores = model.stages[-1].featureImportances
    rows = sorted(((n, float(scores[i])) for i, n in enumerate(names)), key=lambda r: -r[1])
    return spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(rows, 1)], "rank int, feature string, importance double")
