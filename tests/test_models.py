"""What the model queries must hold: they have no SQL twin."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydrolake.operators import grouped_models, models
from hydrolake.plans import forecast, registry

SF = "/root/testdata/sf0.01"
TESTED = {"l3_fit_occurrence", "l3_fit_occurrence_by_group", "l4_fit_magnitude", "l5_tune", "l8_ridge_stack", "l12_fit_pixel_classifier", "l13_classify_pixels", "l14_feature_importance", "a39_importance_by_group"}


@pytest.fixture(scope="module")
def run(spark):
    known = {}

    def get(name):
        if name not in known:
            known[name] = registry.queries()[name](spark, SF).toPandas()
        return known[name]

    return get


def rmse(a, b):
    return math.sqrt(((a - b) ** 2).mean())


def rank_sum(p, wet):
    """Area under the curve, by ranks."""
    r, n = p.rank(), wet.sum()
    return (r[wet == 1].sum() - n * (n + 1) / 2) / (n * (len(wet) - n))


def test_occurrence_is_told_from_dry_days(run):
    x = run("l3_fit_occurrence")
    assert x.p.between(0, 1).all() and x.row_id.is_unique and x.wet.nunique() == 2
    assert rank_sum(x.p, x.wet) > 0.6  # chance: 0.5


def test_every_test_row_is_predicted(spark, run):
    want = {r.row_id for r in forecast.training(spark, SF).where("split = 'test'").select("row_id").collect()}
    for name in ("l3_fit_occurrence", "l4_fit_magnitude", "l8_ridge_stack"):
        assert set(run(name).row_id) == want and len(run(name)) == len(want)


def test_magnitude_beats_the_mean(spark, run):
    x = run("l4_fit_magnitude")
    mean = forecast.training(spark, SF).where("split = 'train' AND y > 0").agg(F.avg("y")).first()[0]
    wet = x[x.y > 0]
    for kind in ("gbt", "forest", "linear"):
        assert rmse(wet[kind], wet.y) < 0.8 * rmse(mean, wet.y)


def test_stack_is_no_worse_than_its_inputs(spark, run):
    x = forecast.training(spark, SF).where("split = 'test'").select("row_id", "y", "m1", "m2").toPandas().merge(run("l8_ridge_stack"), on="row_id")
    assert rmse(x.stacked, x.y) <= min(rmse(x.m1, x.y), rmse(x.m2, x.y))


def test_deeper_trees_are_tuned(run):
    x = run("l5_tune").set_index("max_depth").rmse
    assert set(x.index) == {2, 4} and (x > 0).all() and x[4] < x[2]


def test_pixel_classes(spark, run):
    scores = run("l12_fit_pixel_classifier")
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").groupBy("label").count().collect()
    assert dict(zip(scores["class"], scores.support, strict=True)) == {r.label: -(-r["count"] // 5) for r in rows} and scores.f1.between(0, 1).all()
    assert scores.max_depth.nunique() == 1 and scores.trees.nunique() == 1
    x = run("l13_classify_pixels")
    outside = x.vec_id % 5 == 0
    assert len(x) == spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert (x.klass[outside] == 255).all() and x.klass[~outside].between(0, 9).all()


def test_classes_that_bands_tell_are_found(spark):
    """The labels of the table are noise to its bands, so here the greatest of three bands is the class."""
    pixels = forecast.pixel_rows(spark, SF).drop("label").withColumn("label", F.array_position(F.array("b0", "b1", "b2"), F.greatest("b0", "b1", "b2")).cast("int") - 1)
    pixels = pixels.withColumn("b3", F.when(F.col("vec_id") % 7 > 0, F.col("b3")))  # missing values take the median
    held = F.col("vec_id") % 4 == 0
    model = models.fit_pixel_classifier(pixels.where(~held), forecast.BANDS[:6], "label")
    found = models.classify_pixels(model, pixels.where(held).withColumn("inside", F.lit(True)), forecast.BANDS[:6], "inside")
    assert found.agg(F.avg((F.col("klass") == F.col("label")).cast("int"))).first()[0] > 0.7  # chance: a third
    importance = {r.feature: r.importance for r in models.feature_importance(model, forecast.BANDS[:6], spark).collect()}
    assert min(importance[b] for b in ("b0", "b1", "b2")) > max(importance[b] for b in ("b3", "b4", "b5"))


def test_the_better_setting_is_chosen(spark):
    """Two bands in turn (odd or even steps) tell the class: a forest of one split can't, one of five can."""
    pixels = forecast.pixel_rows(spark, SF).withColumn("label", F.when(F.col("vec_id") % 11 == 0, 2).otherwise(((F.col("b0") > 0) != (F.col("b1") > 0)).cast("int")))
    pixels = pixels.withColumn("b2", F.when(F.col("label") == 2, 9.0).otherwise(F.col("b2")))
    _, setting, scores = models.select_pixel_classifier(pixels, forecast.BANDS[:3], "label", "vec_id", depths=(1, 6), trees=(9,), folds=3)
    f1 = {r["class"]: r.f1 for r in scores.collect()}
    assert setting["max_depth"] == 6 and set(f1) == {0, 1, 2}
    assert f1[2] > 0.9 and min(f1[0], f1[1]) > 0.6


def test_macro_f1(spark):
    rows = [(0, 0.0)] * 8 + [(0, 1.0)] * 2 + [(1, 1.0)] * 3 + [(1, 0.0)] + [(2, 1.0)]
    df = spark.createDataFrame(rows, "y int, z double")
    assert models.macro_f1(df, "y", "z") == pytest.approx((16 / 19 + 6 / 10 + 0) / 3)


@pytest.fixture(scope="module")
def groups(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g, n in (("a", 400), ("b", 60), ("few", 30), ("split", 40), ("still", 50)):
        x, z = rng.normal(5, 2, n), rng.normal(size=n)
        y = (rng.random(n) < 1 / (1 + np.exp(-(x - 5 + 0.5 * z)))).astype(int)
        if g == "few":
            y[:] = 0
            y[:2] = 1
        if g == "split":
            y = (x > 5).astype(int)
        if g == "still":
            z[:] = 1.0
        rows += [(g, *map(float, r)) for r in zip(x, z, 3 + 2 * x - z + rng.normal(size=n) * 0.1, y, strict=True)]
    rows += [("a", None, 1.0, 1.0, 1.0), ("a", 1.0, 1.0, None, None)]
    return rows, spark.createDataFrame(rows, "g string, x double, z double, v double, y double").repartition(3)


def test_linear_fits_of_groups(groups):
    rows, df = groups
    got = {r.g: (r.n, r.coef) for r in grouped_models.fit_linear(df, ["g"], ["x", "z"], "v").collect()}
    for g in ("a", "b", "few", "split", "still"):
        own = np.array([r[1:4] for r in rows if r[0] == g and None not in r], float)
        if g == "still":  # a feature that never varies
            want = np.r_[np.polyfit(own[:, 0], own[:, 2], 1)[::-1], 0.0]
        else:
            want = np.linalg.lstsq(np.c_[np.ones(len(own)), own[:, :2]], own[:, 2], rcond=None)[0]
        assert got[g][0] == len(own) and np.allclose(got[g][1], want, atol=1e-8)


def test_logistic_fits_of_groups(groups):
    rows, df = groups
    ridge = 1e-3
    found = {r.g: r for r in grouped_models.fit_logistic(df, ["g"], ["x", "z"], "y", ridge).collect()}
    assert found["few"].coef is None and (found["few"].n_pos, found["few"].n_neg) == (2, 28)
    for g in ("a", "b", "split"):
        own = np.array([r[1:] for r in rows if r[0] == g and None not in r], float)
        x, y = own[:, :2], own[:, 3]
        mean, dev = x.mean(0), x.std(0)
        design, weight = np.c_[np.ones(len(x)), (x - mean) / dev], np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
        coef, held = np.zeros(3), ridge * weight.sum() * np.array([0, 1, 1])
        for _ in range(200):
            p = 1 / (1 + np.exp(-design @ coef))
            coef += np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + np.diag(held), design.T @ (weight * (y - p)) - held * coef)
        slopes = coef[1:] / dev
        assert np.allclose(found[g].coef, [coef[0] - slopes @ mean, *slopes], atol=1e-6)
    scored = grouped_models.predict_occurrence(df.dropna(), grouped_models.fit_logistic(df, ["g"], ["x", "z"], "y"), ["g"], ["x", "z"])
    assert scored.where("g = 'few' AND p IS NOT NULL").isEmpty() and scored.where("g = 'split' AND (p > 0.5) <> (y = 1)").count() <= 2


def test_occurrence_by_group(spark, run):
    x = run("l3_fit_occurrence_by_group")
    want = {r.row_id for r in forecast.training(spark, SF).where("split = 'test'").select("row_id").collect()}
    assert set(x.row_id) == want and len(x) == len(want) and x.p.between(0, 1).all()
    assert rank_sum(x.p, x.wet) > 0.6


def test_importances_are_shares(run):
    x, grouped = run("l14_feature_importance"), run("a39_importance_by_group")
    assert x.importance.sum() == pytest.approx(1) and (x.importance >= 0).all() and x.importance.is_monotonic_decreasing
    assert sorted(x["rank"]) == list(range(1, len(forecast.BANDS) + 1)) and set(x.feature) == set(forecast.BANDS)
    assert grouped.importance.sum() == pytest.approx(1, abs=1e-5) and grouped.features.sum() == len(x)
