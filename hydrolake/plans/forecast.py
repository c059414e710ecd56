"""Queries: forecast skill, uncertainty, reservoir model inputs, models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolake.operators import features, grouped_models, models, series, skill


from hydrolake.plans.helpers import dt, rd, sql, tidy
from hydrolake.plans.registry import register
from hydrolake.plans.telemetry import balance
from hydrolake.plans import telemetry as T
from hydrolake.sources import readers
from hydrolake.sources.shared import fresh_path
from hydrolake.sources.views import view

ZH = ["zone", "horizon"]
P = ", p AS (SELECT *, prob * greatest(6e-1 * m1 + 4e-1 * m2, 0e0) AS yhat, y > 0 AS pos FROM predictions)"


def preds(spark, sf_dir) -> DataFrame:
    x = view(spark, sf_dir, "predictions")
    return x.withColumn("yhat", skill.two_stage(F.col("prob"), F.col("m1"), F.col("m2"), F.lit(0.6), F.lit(0.4))).withColumn("pos", F.col("y") > 0)


@register("l6_two_stage_predict", sql("predictions", P + f"SELECT row_id, {rd('yhat', 'yhat', 3)} FROM p"))
def l6_two_stage_predict(spark, sf_dir):
    return tidy(preds(spark, sf_dir).select("row_id", "yhat"), 3)


@register("l7_hurdle_predict", sql("predictions", f"SELECT row_id, {rd('CASE WHEN row_id % 10 = 0 OR year > 2000 THEN NULL WHEN 1 - prob >= 0.5 THEN 0e0 ELSE greatest(y + (m1 - m2), 0e0) END', 'q', 3)} FROM predictions"))
def l7_hurdle_predict(spark, sf_dir):
    x = view(spark, sf_dir, "predictions")
    delta = F.when(F.col("row_id") % 10 != 0, F.col("m1") - F.col("m2"))
    return tidy(x.select("row_id", skill.hurdle(1 - F.col("prob"), 0.5, F.col("y"), delta, F.col("year") > 2000).alias("q")), 3)


REG = f"""count(*) AS n, {rd('avg(abs(yhat - y))', 'mae')}, {rd('sqrt(avg((yhat - y) * (yhat - y)))', 'rmse')}, {rd('1 - sum((yhat - y) * (yhat - y)) / nullif(count(y) * var_pop(y), 0)', 'nse')},
 {rd('CASE WHEN stddev_pop(yhat) > 0 AND stddev_pop(y) > 0 THEN 1 - sqrt(pow(corr(yhat, y) - 1, 2) + pow(stddev_pop(yhat) / nullif(stddev_pop(y), 0) - 1, 2) + pow(avg(yhat) / nullif(avg(y), 0) - 1, 2)) END', 'kge')},
 {rd('100 * sum(yhat - y) / nullif(sum(y), 0)', 'pbias')}, {rd('100 * avg(CASE WHEN y <> 0 THEN abs((yhat - y) / y) END)', 'mape')}"""


@register("a24_regression_skill", sql("predictions", P + f"SELECT zone, horizon, {REG} FROM p GROUP BY 1, 2"))
def a24_regression_skill(spark, sf_dir):
    return tidy(skill.regression_skill(preds(spark, sf_dir), ZH, "y", "yhat"))


@register("l11_skill_table", sql("predictions", P + f", m AS (SELECT zone, horizon, 'two_stage' AS model, y, yhat FROM p UNION ALL SELECT zone, horizon, 'single', y, m1 FROM p UNION ALL SELECT zone, horizon, 'two_stage_wet', y, yhat FROM p WHERE pos) SELECT model, zone, horizon, {REG} FROM m GROUP BY 1, 2, 3"))
def l11_skill_table(spark, sf_dir):
    x = preds(spark, sf_dir)
    rows = lambda d, n, c: d.select("zone", "horizon", F.lit(n).alias("model"), "y", F.col(c).alias("yhat"))
    all_ = rows(x, "two_stage", "yhat").unionByName(rows(x, "single", "m1")).unionByName(rows(x.where("pos"), "two_stage_wet", "yhat"))
    return tidy(skill.regression_skill(all_, ["model", *ZH], "y", "yhat"))


@register("a25_regime_skill", sql("predictions", P + f"""SELECT zone, horizon, {rd('avg(abs(yhat - y)) FILTER (WHERE pos)', 'wet_mae')}, {rd('avg(abs(yhat - y)) FILTER (WHERE NOT pos)', 'dry_mae')}, {rd('1 - sum((yhat - y) * (yhat - y)) FILTER (WHERE pos) / nullif(count(*) FILTER (WHERE pos) * var_pop(y) FILTER (WHERE pos), 0)', 'wet_nse')},
 {rd('100 * avg(abs((yhat - y) / y)) FILTER (WHERE pos)', 'wet_mape')}, {rd('100 * avg(CASE WHEN yhat < 5000 THEN 1e0 ELSE 0e0 END) FILTER (WHERE NOT pos)', 'zero_hit_pct')},
 {rd('2e0 * count(*) FILTER (WHERE pos AND yhat >= 5000) / nullif(2 * count(*) FILTER (WHERE pos AND yhat >= 5000) + count(*) FILTER (WHERE NOT pos AND yhat >= 5000) + count(*) FILTER (WHERE pos AND yhat < 5000), 0)', 'regime_f1')} FROM p GROUP BY 1, 2"""))
def a25_regime_skill(spark, sf_dir):
    return tidy(skill.regime_skill(preds(spark, sf_dir), ZH, "y", "yhat"))


@register("a26_binary_skill", sql("predictions", P + f"""
, b AS (SELECT zone, horizon, count(*) FILTER (WHERE pos AND prob >= 0.5) AS tp, count(*) FILTER (WHERE NOT pos AND prob >= 0.5) AS fp, count(*) FILTER (WHERE pos AND prob < 0.5) AS fn, count(*) FILTER (WHERE NOT pos AND prob < 0.5) AS tn FROM p GROUP BY 1, 2)
, rk AS (SELECT *, rank() OVER (PARTITION BY zone, horizon ORDER BY prob) + (count(*) OVER (PARTITION BY zone, horizon, prob) - 1) / 2e0 AS r FROM p)
, au AS (SELECT zone, horizon, (sum(r) FILTER (WHERE pos) - count(*) FILTER (WHERE pos) * (count(*) FILTER (WHERE pos) + 1) / 2e0) / nullif(count(*) FILTER (WHERE pos) * count(*) FILTER (WHERE NOT pos), 0) AS auc FROM rk GROUP BY 1, 2)
SELECT zone, horizon, tp, fp, fn, tn, {rd('tp * 1e0 / nullif(tp + fp, 0)', 'precision')}, {rd('tp * 1e0 / nullif(tp + fn, 0)', 'recall')}, {rd('2e0 * tp / nullif(2 * tp + fp + fn, 0)', 'f1')}, {rd('tn * 1e0 / nullif(tn + fp, 0)', 'zero_recall')}, {rd('auc', 'auc')} FROM b JOIN au USING (zone, horizon)"""))
def a26_binary_skill(spark, sf_dir):
    return tidy(skill.binary_skill(preds(spark, sf_dir), ZH, "pos", "prob"))


@register("a27_multiclass_skill", sql("predictions", f"""
, k AS (SELECT zone, unnest([0, 1, 2, 3]) AS klass FROM (SELECT DISTINCT zone FROM predictions))
, c AS (SELECT p.zone, CAST(k.klass AS INT) AS klass, count(*) FILTER (WHERE p.klass = k.klass) AS support, count(*) FILTER (WHERE klass_hat = k.klass) AS said, count(*) FILTER (WHERE p.klass = k.klass AND klass_hat = k.klass) AS hits FROM predictions p JOIN k ON p.zone = k.zone GROUP BY 1, 2)
SELECT zone, klass, support, said, CAST(hits AS BIGINT) AS hits, {rd('hits * 1e0 / nullif(said, 0)', 'precision')}, {rd('hits * 1e0 / nullif(support, 0)', 'recall')}, {rd('2e0 * hits / nullif(said + support, 0)', 'f1')} FROM c WHERE support + said > 0"""))
def a27_multiclass_skill(spark, sf_dir):
    return tidy(skill.multiclass_skill(view(spark, sf_dir, "predictions"), ["zone"], "klass", "klass_hat"))


GRID = ", ".join(f"{t}e0" for t in skill.THRESHOLDS)


@register("a28_best_threshold", sql("predictions", P + f"""
, g AS (SELECT unnest([{GRID}]) AS t)
, f AS (SELECT zone, horizon, t, coalesce(round(2e0 * count(*) FILTER (WHERE pos AND prob >= t) / nullif(count(*) FILTER (WHERE pos) + count(*) FILTER (WHERE prob >= t), 0), 12), 0) AS f1 FROM p CROSS JOIN g GROUP BY 1, 2, 3)
SELECT zone, horizon, {rd('CASE WHEN f1 > 0 THEN t ELSE 0.5e0 END', 'threshold')}, {rd('f1', 'f1')} FROM (SELECT *, row_number() OVER (PARTITION BY zone, horizon ORDER BY f1 DESC, t) AS k FROM f) WHERE k = 1"""))
def a28_best_threshold(spark, sf_dir):
    return tidy(skill.best_threshold(preds(spark, sf_dir), ZH, "pos", "prob"))


@register("a29_pr_threshold", sql("predictions", P + f"""
, u AS (SELECT zone, horizon, prob, count(*) FILTER (WHERE pos) AS a, count(*) AS n FROM p GROUP BY 1, 2, 3)
, f AS (SELECT zone, horizon, prob, coalesce(round(2e0 * sum(a) OVER w / nullif(sum(n) OVER w + sum(a) OVER (PARTITION BY zone, horizon), 0), 12), 0) AS f1 FROM u WINDOW w AS (PARTITION BY zone, horizon ORDER BY prob DESC))
SELECT zone, horizon, {rd('prob', 'threshold')}, {rd('f1', 'f1')} FROM (SELECT *, row_number() OVER (PARTITION BY zone, horizon ORDER BY f1 DESC, prob DESC) AS k FROM f) WHERE k = 1"""))
def a29_pr_threshold(spark, sf_dir):
    return tidy(skill.pr_threshold(preds(spark, sf_dir), ZH, "pos", "prob"))


MAE2 = ", w AS (SELECT zone, horizon, avg(abs(m1 - y)) AS mae_a, avg(abs(m2 - y)) AS mae_b FROM predictions WHERE split = 'calib' GROUP BY 1, 2)"


@register("a30_inverse_mae_weights", sql("predictions", MAE2 + f"SELECT zone, horizon, {rd('mae_a', 'mae_a', 3)}, {rd('mae_b', 'mae_b', 3)}, {rd('round(mae_b / (mae_a + mae_b), 4)', 'w_a')}, {rd('round(1 - round(mae_b / (mae_a + mae_b), 4), 4)', 'w_b')} FROM w"))
def a30_inverse_mae_weights(spark, sf_dir):
    x = skill.inverse_error_weights(view(spark, sf_dir, "predictions").where("split = 'calib'"), ZH, "y", "m1", "m2")
    return x.select(*ZH, *[F.round(c, 3).alias(c) for c in ("mae_a", "mae_b")], "w_a", "w_b")


VARIANTS = ("yhat", "m1", "m2")
VAR = P + ", v AS (" + " UNION ALL ".join(f"SELECT zone, horizon, '{c}' AS variant, avg(abs({c} - y)) AS mae FROM p WHERE split = 'test' GROUP BY 1, 2" for c in VARIANTS) + ")"


def variants(spark, sf_dir) -> DataFrame:
    x = preds(spark, sf_dir).where("split = 'test'").groupBy(*ZH).agg(*[F.avg(F.abs(F.col(c) - F.col("y"))).alias(c) for c in VARIANTS])
    return x.unpivot(ZH, list(VARIANTS), "variant", "mae")


@register("g10_metrics_long", sql("predictions", VAR + f"SELECT zone, horizon, variant, {rd('mae', 'mae')} FROM v"))
def g10_metrics_long(spark, sf_dir):
    return tidy(variants(spark, sf_dir))


@register("a31_best_per_group", sql("predictions", VAR + f"SELECT zone, horizon, variant, {rd('-mae', 'score')} FROM (SELECT *, row_number() OVER (PARTITION BY zone, horizon ORDER BY mae, variant) AS k FROM v) WHERE k = 1"))
def a31_best_per_group(spark, sf_dir):
    return tidy(skill.best_per_group(variants(spark, sf_dir).withColumn("score", -F.col("mae")), ZH, "score", "variant"))


@register("a44_win_counts", sql("predictions", VAR + f"SELECT zone, variant, count(*) FILTER (WHERE mae = best) AS wins, count(*) FILTER (WHERE mae < 90000) AS under_target, {rd('avg(mae)', 'mean')} FROM (SELECT *, min(mae) OVER (PARTITION BY zone, horizon) AS best FROM v) GROUP BY 1, 2"))
def a44_win_counts(spark, sf_dir):
    return tidy(skill.win_counts(variants(spark, sf_dir), ["zone"], "horizon", "variant", "mae", 90000))


@register("a34_improvement_pct", sql("predictions", P + f"SELECT zone, horizon, {rd('100 * (avg(abs(m1 - y)) - avg(abs(yhat - y))) / nullif(avg(abs(m1 - y)), 0)', 'improvement_pct')} FROM p GROUP BY 1, 2"))
def a34_improvement_pct(spark, sf_dir):
    x = preds(spark, sf_dir).groupBy(*ZH).agg(F.avg(F.abs(F.col("yhat") - F.col("y"))).alias("model"), F.avg(F.abs(F.col("m1") - F.col("y"))).alias("base"))
    return tidy(skill.improvement(x, ZH, "model", "base").select(*ZH, "improvement_pct"))


@register("a32_cv_stability", sql("predictions", P + f", s AS (SELECT horizon, row_id % 5 AS fold, avg(abs(yhat - y)) AS mae FROM p GROUP BY 1, 2) SELECT horizon, {rd('avg(mae)', 'mean')}, {rd('stddev_samp(mae)', 'std')}, count(mae) AS folds FROM s GROUP BY 1"))
def a32_cv_stability(spark, sf_dir):
    x = preds(spark, sf_dir).groupBy("horizon", (F.col("row_id") % 5).alias("fold")).agg(F.avg(F.abs(F.col("yhat") - F.col("y"))).alias("mae"))
    return tidy(skill.cv_stability(x, ["horizon"], "mae"))


_U = "(v * 48271 % 2147483647 + r * 7919 + 5) % 2147483647"
_BOOT = P + f"""
, h1 AS (SELECT zone, horizon, abs(yhat - y) AS e, r, {_U.replace('v', 'row_id')} AS h FROM p CROSS JOIN (SELECT range AS r FROM range(1, 201)))
, h2 AS (SELECT zone, horizon, e, r, h * h % 2147483647 + 12345 AS h FROM h1)
, h3 AS (SELECT zone, horizon, e, r, (h * h % 2147483647) / 2147483647e0 AS u FROM h2)
, k AS (SELECT zone, horizon, e, r, {' + '.join(f'CAST(u >= {s}e0 AS INT)' for s in skill.poisson_steps(2**31 - 1))} AS k FROM h3)
, s AS (SELECT zone, horizon, r, sum(e * k) / sum(k) AS stat FROM k WHERE k > 0 GROUP BY 1, 2, 3)
, ci AS (SELECT zone, horizon, quantile_cont(stat, 0.025) AS low, quantile_cont(stat, 0.975) AS high FROM s GROUP BY 1, 2)
SELECT zone, horizon, {rd('low', 'low', 3)}, {rd('high', 'high', 3)}, {rd('point', 'point', 3)} FROM ci JOIN (SELECT zone, horizon, avg(abs(yhat - y)) AS point FROM p GROUP BY 1, 2) USING (zone, horizon)"""


@register("a33_bootstrap_ci", sql("predictions", _BOOT))
def a33_bootstrap_ci(spark, sf_dir):
    return tidy(skill.bootstrap_ci(preds(spark, sf_dir), ZH, "row_id", "y", "yhat"), 3)


@register("a45_benchmark_table", sql("predictions", P + f"""
, s AS (SELECT horizon, 'two_stage' AS model, avg(abs(yhat - y)) AS mae, sqrt(avg((yhat - y) * (yhat - y))) AS rmse, avg(abs(m2 - y)) AS bm, sqrt(avg((m2 - y) * (m2 - y))) AS br FROM p GROUP BY 1 UNION ALL SELECT horizon, 'single', avg(abs(m1 - y)), sqrt(avg((m1 - y) * (m1 - y))), avg(abs(m2 - y)), sqrt(avg((m2 - y) * (m2 - y))) FROM p GROUP BY 1)
SELECT horizon, model, {rd('mae', 'mae', 3)}, {rd('rmse', 'rmse', 3)} FROM s UNION ALL SELECT horizon, 'Persistence', {rd('bm', 'mae', 3)}, {rd('br', 'rmse', 3)} FROM s WHERE model = 'single'"""))
def a45_benchmark_table(spark, sf_dir):
    err = lambda c: F.col(c) - F.col("y")
    x = preds(spark, sf_dir)
    row = lambda n, c: x.groupBy("horizon").agg(F.lit(n).alias("model"), F.avg(F.abs(err(c))).alias("mae"), F.sqrt(F.avg(err(c) * err(c))).alias("rmse"), F.avg(F.abs(err("m2"))).alias("base_mae"), F.sqrt(F.avg(err("m2") * err("m2"))).alias("base_rmse"))
    return tidy(skill.benchmark_table(row("two_stage", "yhat").unionByName(row("single", "m1")), "single", ["mae", "rmse"]), 3)


def split(spark, sf_dir, part):
    return preds(spark, sf_dir).where(F.col("split") == part)


def _quantile(source: str, by: str) -> str:
    """SQL of the conformal quantile of s over ``by``."""
    return f"""SELECT {by}, n, lo + (hi - lo) * (pos - floor(pos)) AS q FROM (SELECT {by}, n, pos, min(s) AS lo, max(s) AS hi FROM (
 SELECT *, least(ceil(round((n + 1) * 9e-1, 9)) / n, 1e0) * (n - 1) + 1 AS pos FROM (SELECT *, count(*) OVER (PARTITION BY {by}) AS n, row_number() OVER (PARTITION BY {by} ORDER BY s) AS i FROM {source}))
 WHERE i = floor(pos) OR i = ceil(pos) GROUP BY {by}, n, pos)"""


SCORES = P + ", sc AS (SELECT zone, horizon, CASE WHEN y > 0 THEN 'wet' ELSE 'dry' END AS regime, abs(y - yhat) / (yhat + 1000) AS s FROM p WHERE split = 'calib')"
CONF = SCORES + f""", q0 AS ({_quantile('sc', 'zone, horizon')}), q1 AS ({_quantile('sc', 'zone, horizon, regime')})
, t AS (SELECT *, CASE WHEN prob >= 0.5 THEN 'wet' ELSE 'dry' END AS regime FROM p WHERE split = 'test')
, ci AS (SELECT t.*, coalesce(CASE WHEN q1.n >= 5 THEN q1.q END, q0.q) AS q FROM t LEFT JOIN q0 USING (zone, horizon) LEFT JOIN q1 USING (zone, horizon, regime))
, iv AS (SELECT *, greatest(0e0, yhat - q * (yhat + 1000)) AS low, yhat + q * (yhat + 1000) AS high FROM ci)"""


@register("a22_conformal_quantile", sql("predictions", SCORES + f", qq AS ({_quantile('sc', 'zone, horizon')}) SELECT zone, horizon, n, {rd('q', 'q')} FROM qq"))
def a22_conformal_quantile(spark, sf_dir):
    x = split(spark, sf_dir, "calib").withColumn("s", F.abs(F.col("y") - F.col("yhat")) / (F.col("yhat") + 1000))
    return tidy(skill.conformal_quantile(x, ZH, "s"))


def intervals(spark, sf_dir, variant="D"):
    return skill.conformal_intervals(split(spark, sf_dir, "calib"), split(spark, sf_dir, "test"), ZH, "y", "yhat", "prob", 0.5, variant)


@register("l9_conformal_intervals", sql("predictions", CONF + f"SELECT row_id, regime, {rd('low', 'low', 3)}, {rd('high', 'high', 3)} FROM iv"))
def l9_conformal_intervals(spark, sf_dir):
    return tidy(intervals(spark, sf_dir).select("row_id", "regime", "low", "high"), 3)


def _variant(v: str) -> str:
    """Common tables of one variant: scores, quantiles over all and by regime, intervals."""
    score, half = ("abs(y - yhat) / (yhat + 1000)", "q * (yhat + 1000)") if v in "CD" else ("abs(y - yhat)", "q")
    q = "coalesce(CASE WHEN q1.n >= 5 THEN q1.q END, q0.q)" if v in "BD" else "q0.q"
    return f""", sc{v} AS (SELECT zone, horizon, CASE WHEN y > 0 THEN 'wet' ELSE 'dry' END AS regime, {score} AS s FROM p WHERE split = 'calib')
, qa{v} AS ({_quantile(f'sc{v}', 'zone, horizon')}), qb{v} AS ({_quantile(f'sc{v}', 'zone, horizon, regime')})
, iv{v} AS (SELECT row_id, regime, greatest(0e0, yhat - {half}) AS low, yhat + {half} AS high FROM (SELECT t.*, {q} AS q FROM (SELECT *, CASE WHEN prob >= 0.5 THEN 'wet' ELSE 'dry' END AS regime FROM p WHERE split = 'test') t LEFT JOIN qa{v} q0 USING (zone, horizon) LEFT JOIN qb{v} q1 USING (zone, horizon, regime)))"""


@register("l9_conformal_variants", sql("predictions", P + "".join(map(_variant, "ABC")) + " UNION ALL ".join(f" SELECT row_id, '{v}' AS variant, regime, {rd('low', 'low', 3)}, {rd('high', 'high', 3)} FROM iv{v}" for v in "ABC")))
def l9_conformal_variants(spark, sf_dir):
    """A: absolute scores over all; B: by regime; C: scores relative to the prediction, over all. D is l9_conformal_intervals."""
    each = [intervals(spark, sf_dir, v).select("row_id", F.lit(v).alias("variant"), "regime", "low", "high") for v in "ABC"]
    return tidy(models.union_all(each), 3)


@register("a23_coverage_stats", sql("predictions", CONF + f"""SELECT zone, horizon, {rd('avg(CASE WHEN y BETWEEN low AND high THEN 1e0 ELSE 0e0 END)', 'coverage')}, {rd('avg(CASE WHEN y BETWEEN low AND high THEN 1e0 ELSE 0e0 END) FILTER (WHERE y > 0)', 'wet_coverage')}, {rd('avg(CASE WHEN y BETWEEN low AND high THEN 1e0 ELSE 0e0 END) FILTER (WHERE y <= 0)', 'dry_coverage')},
 {rd('avg(high - low)', 'mean_width', 3)}, {rd('quantile_cont(high - low, 0.5)', 'median_width', 3)}, {rd('avg(high - low) FILTER (WHERE y > 0)', 'wet_width', 3)} FROM iv GROUP BY 1, 2"""))
def a23_coverage_stats(spark, sf_dir):
    x = skill.coverage(intervals(spark, sf_dir), ZH)
    return x.select(*ZH, *[F.round(c, 4).alias(c) for c in ("coverage", "wet_coverage", "dry_coverage")], *[F.round(c, 3).alias(c) for c in ("mean_width", "median_width", "wet_width")])


@register("l10_baselines", sql("predictions", f"""
, q AS (SELECT zone, date, sum(CAST(round(y) AS BIGINT)) AS y FROM predictions GROUP BY 1, 2)
, lags AS (SELECT *, {', '.join(f'lag(y, {k}) OVER w AS l{k}' for k in (1, 2, 3, 4, 8, 12))} FROM q WINDOW w AS (PARTITION BY zone ORDER BY date))
, m AS (SELECT zone, avg(y) AS clim FROM q WHERE year(date) < 1998 GROUP BY 1)
SELECT zone, {dt('date', 'date')}, CAST(l4 AS BIGINT) AS persistence_h5, CAST(l8 AS BIGINT) AS persistence_h7, {rd('clim', 'climatology', 3)} FROM lags JOIN m USING (zone) WHERE year(date) >= 2000"""))
def l10_baselines(spark, sf_dir):
    q = view(spark, sf_dir, "predictions").groupBy("zone", "date").agg(F.sum(F.round("y").cast("long")).alias("y"))
    x = series.row_lags(q, ["zone"], "date", "y", (1, 2, 3, 4, 8, 12))
    mean = q.where(F.year("date") < 1998).groupBy("zone").agg(F.avg("y").alias("climatology"))
    lag = lambda h: F.col(f"y_lag{skill.nearest_lag(h)}").alias(f"persistence_h{h}")
    return tidy(x.join(mean, "zone").where(F.year("date") >= 2000).select("zone", "date", lag(5), lag(7), "climatology"), 3)


@register("j17_feature_target_join", sql("predictions", f"""
, q AS (SELECT zone, year, CAST(week(date) AS INT) AS wk, sum(CAST(round(y) AS BIGINT)) AS y FROM predictions GROUP BY 1, 2, 3), l AS (SELECT *, lag(y) OVER (PARTITION BY zone ORDER BY year, wk) AS prev FROM q)
SELECT p.row_id, CAST(l.prev AS BIGINT) AS prev FROM predictions p JOIN l ON l.zone = p.zone AND l.year = p.year AND l.wk = week(p.date) WHERE p.split = 'test'"""))
def j17_feature_target_join(spark, sf_dir):
    p = view(spark, sf_dir, "predictions").withColumn("wk", F.weekofyear("date"))
    q = p.groupBy("zone", "year", "wk").agg(F.sum(F.round("y").cast("long")).alias("y"))
    lagged = series.row_lags(q, ["zone"], ["year", "wk"], "y", [1]).select("zone", "year", "wk", F.col("y_lag1").alias("prev"))
    return p.where("split = 'test'").select("row_id", "zone", "year", "wk").join(lagged, ["zone", "year", "wk"]).select("row_id", "prev")


@register("w16_chrono_split", sql("predictions", """
, s AS (SELECT row_id, zone, CASE WHEN year < 1997 THEN 'before' WHEN year < 1999 THEN 'dry' ELSE 'after' END AS block FROM predictions)
, n AS (SELECT *, count(*) OVER (PARTITION BY zone, block) AS n, row_number() OVER (PARTITION BY zone, block ORDER BY row_id) AS i FROM s)
SELECT row_id, zone, block, CASE WHEN i <= round_even(0.70e0 * n, 0) THEN 'train' WHEN i <= CASE WHEN block = 'dry' THEN round_even(0.70e0 * n, 0) + round_even(0.15e0 * n, 0) ELSE round_even(0.85e0 * n, 0) END THEN 'calib' ELSE 'test' END AS part FROM n"""))
def w16_chrono_split(spark, sf_dir):
    x = view(spark, sf_dir, "predictions").select("row_id", "zone", F.when(F.col("year") < 1997, "before").when(F.col("year") < 1999, "dry").otherwise("after").alias("block"))
    return series.chrono_split(x, ["zone"], "block", "row_id", "dry").select("row_id", "zone", "block", "part")


@register("w17_ts_folds", sql("predictions", """
, n AS (SELECT row_id, zone, horizon, count(*) OVER (PARTITION BY zone, horizon) AS n, row_number() OVER (PARTITION BY zone, horizon ORDER BY row_id) - 1 AS i FROM predictions)
, f AS (SELECT *, n // 6 AS b, CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS fold FROM n)
SELECT row_id, zone, horizon, fold, CASE WHEN i < n - (5 - fold + 1) * b THEN 'train' ELSE 'test' END AS role FROM f WHERE i < n - (5 - fold + 1) * b + b"""))
def w17_ts_folds(spark, sf_dir):
    x = view(spark, sf_dir, "predictions").select("row_id", "zone", "horizon")
    return series.ts_folds(x, ZH, "row_id", 5).select("row_id", *ZH, "fold", "role")


@register("w18_stratified_folds", sql("predictions", "SELECT row_id, klass, (row_number() OVER (PARTITION BY klass ORDER BY md5(concat(row_id, ':0')), row_id) - 1) % 5 AS fold FROM predictions"))
def w18_stratified_folds(spark, sf_dir):
    return series.stratified_folds(view(spark, sf_dir, "predictions").select("row_id", "klass"), "klass", "row_id", 5)


@register("g9_match_rate_sample", sql("predictions", P + """
, r AS (SELECT row_id, zone, pos, round(sum(CAST(pos AS INT)) OVER (PARTITION BY zone) * 0.19999999999999996e0 / 0.8e0) AS want, row_number() OVER (PARTITION BY zone, pos ORDER BY md5(concat(row_id, ':0')), row_id) AS k FROM p)
SELECT row_id, zone, pos FROM r WHERE pos OR k <= want"""))
def g9_match_rate_sample(spark, sf_dir):
    return series.match_rate_sample(preds(spark, sf_dir).select("row_id", "zone", "pos"), ["zone"], "pos", "row_id", 0.8)


@register("p24_complete_rows", sql("predictions", f"SELECT {dt('date', 'date')}, {rd('m1', 'm1', 3)}, {rd('m2', 'm2', 3)}, {rd('y', 'y', 3)} FROM predictions WHERE horizon <> 3"))
def p24_complete_rows(spark, sf_dir):
    x = view(spark, sf_dir, "predictions").withColumn("y", F.when(F.col("horizon") != 3, F.col("y")))
    return tidy(features.complete_rows(x, ["y"], "date", ["row_id"], "m"), 3)


STATE = T.MARKS + T.SPILL + T.COVER + T.BALANCE + """
, k AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY date) AS i FROM bal WHERE rain_24h_mm IS NOT NULL)
, api AS (SELECT a.station, a.date, sum(pow(0.95e0, a.i - b.i) * b.rain_24h_mm) AS api FROM k a JOIN k b ON a.station = b.station AND b.i <= a.i GROUP BY 1, 2)
, st AS (SELECT b.station, b.date, 100 * storage_m3 / 1.2e6 AS pct_full, storage_m3 - lag(storage_m3) OVER (PARTITION BY b.station ORDER BY b.date) AS delta_s, api FROM bal b LEFT JOIN api a ON a.station = b.station AND a.date = b.date)"""
TV = "telemetry_long rating_curve release_events"


def state(spark, sf_dir):
    return features.daily_state(balance(spark, sf_dir), ["station"], 1.2e6)


@register("a21_daily_state", sql(TV, STATE + f"SELECT station, {dt('date', 'date')}, {rd('pct_full', 'pct_full')}, {rd('delta_s', 'delta_s', 3)}, {rd('sqrt(api)', 'api', 6)} FROM st"))
def a21_daily_state(spark, sf_dir):
    x = state(spark, sf_dir)
    return x.select("station", F.col("date").cast("string").alias("date"), F.round("pct_full", 4).alias("pct_full"), (F.round("delta_s", 3) + 0.0).alias("delta_s"), F.round(F.sqrt("api"), 6).alias("api"))


@register("p13_plausible_rows", sql(TV, STATE + f"SELECT station, {dt('date', 'date')}, delta_s IS NOT NULL AND api IS NOT NULL AND pct_full <= 105 AS valid FROM st"))
def p13_plausible_rows(spark, sf_dir):
    return tidy(state(spark, sf_dir).select("station", "date", "valid"))


@register("p21_scale_min_max", sql("predictions", f", f AS (SELECT min(m1) AS a, max(m1) AS b FROM predictions WHERE split = 'train') SELECT row_id, {rd('(m1 - a) / (b - a)', 'm1', 6)} FROM predictions, f"))
def p21_scale_min_max(spark, sf_dir):
    x = view(spark, sf_dir, "predictions")
    return tidy(features.scale_min_max(x.where("split = 'train'"), x.select("row_id", "m1"), ["m1"]), 6)


@register("a43_pipeline_status", sql("predictions", """
, s AS (SELECT zone, horizon, CASE WHEN row_id % 3001 = 0 THEN 'blocked' WHEN row_id % 701 = 0 THEN 'fallback' WHEN row_id % 97 = 0 THEN 'failed' ELSE 'ok' END AS state FROM predictions)
SELECT zone, horizon, CASE WHEN bool_or(state = 'blocked') THEN 'blocked' WHEN bool_or(state = 'fallback') THEN 'fallback' WHEN bool_and(state = 'failed') THEN 'failed' WHEN bool_or(state = 'failed') THEN 'partial' ELSE 'ok' END AS status FROM s GROUP BY 1, 2"""))
def a43_pipeline_status(spark, sf_dir):
    r = F.col("row_id")
    x = view(spark, sf_dir, "predictions").withColumn("state", F.when(r % 3001 == 0, "blocked").when(r % 701 == 0, "fallback").when(r % 97 == 0, "failed").otherwise("ok"))
    return skill.pipeline_status(x, ZH)


DOCUMENT = sql("predictions", CONF + f"SELECT zone, 'ok' AS status, horizon, {rd('avg(yhat)', 'value', 3)}, {rd('avg(low)', 'low', 3)}, {rd('avg(high)', 'high', 3)} FROM iv GROUP BY 1, 2, 3")


def document(spark, sf_dir) -> DataFrame:
    x = intervals(spark, sf_dir).groupBy("zone", "horizon").agg(F.avg("yhat").alias("value"), F.avg("low").alias("low"), F.avg("high").alias("high")).withColumn("status", F.lit("ok"))
    return readers.forecast_document(x, ["zone"])


def entries(doc: DataFrame) -> DataFrame:
    """A document's entries as rows."""
    return tidy(doc.select("zone", "status", F.explode("horizons").alias("horizon", "x")).select("zone", "status", "horizon", "x.value", "x.low", "x.high"), 3)


@register("s14_build_forecast_document", DOCUMENT)
def s14_build_forecast_document(spark, sf_dir):
    return entries(document(spark, sf_dir))


@register("s12_write_document", DOCUMENT)
def s12_write_document(spark, sf_dir):
    doc, path = document(spark, sf_dir), fresh_path(spark, "document")
    readers.write_document(doc, path)
    kept = "zone string, status string, horizons map<string, struct<value: double, low: double, high: double>>"  # JSON keys are text
    return entries(spark.read.schema(kept).json(path)).withColumn("horizon", F.col("horizon").cast("int"))


# models -----------------------------------------------------------------------------------------------------------
FEATURES = ["prob_noise", "m2", "horizon_d", "week"]


def training(spark, sf_dir) -> DataFrame:
    x = preds(spark, sf_dir)
    return x.select("row_id", "zone", "horizon", "split", "y", "m1", "m2", F.col("pos").cast("int").alias("wet"), (F.col("prob") + (F.col("row_id") % 7) / 10.0).alias("prob_noise"), F.col("horizon").cast("double").alias("horizon_d"), F.weekofyear("date").cast("double").alias("week"), F.when(F.col("zone") == "A", 1.0).otherwise(0.0).alias("zone_code"))


@register("l3_fit_occurrence")
def l3_fit_occurrence(spark, sf_dir):
    x = training(spark, sf_dir)
    out = models.fit_occurrence(x.where("split = 'train'"), x.where("split = 'test'"), FEATURES, "wet", ["zone_code"])
    return out.select("row_id", "wet", F.round("p", 6).alias("p"))


@register("l4_fit_magnitude")
def l4_fit_magnitude(spark, sf_dir):
    x = training(spark, sf_dir)
    out = models.fit_magnitude(x.where("split = 'train'"), x.where("split = 'test'"), FEATURES, "y")
    return out.select("row_id", "y", *[F.round(f"m_{k}", 3).alias(k) for k in ("gbt", "forest", "linear")])


GROUP_FEATURES, ZK = ["prob_noise", "week"], ["zone", "klass"]  # within a horizon of this table all rows are of one class


@register("l3_fit_occurrence_by_group")
def l3_fit_occurrence_by_group(spark, sf_dir):
    """A fit per zone and class of customer, on years of training; groups with fewer than three of a label have no p."""
    x = training(spark, sf_dir).join(view(spark, sf_dir, "predictions").select("row_id", "klass"), "row_id")
    fits = grouped_models.fit_logistic(x.where("split = 'train'"), ZK, GROUP_FEATURES, "wet")
    out = grouped_models.predict_occurrence(x.where("split = 'test'"), fits, ZK, GROUP_FEATURES)
    return out.select("row_id", *ZK, "wet", F.round("p", 5).alias("p"))


def deltas(spark, sf_dir) -> DataFrame:
    """Training rows with the value before (q_now): that of the row before in their zone and horizon."""
    return series.row_lags(training(spark, sf_dir), ZH, "row_id", "y", [1]).withColumnRenamed("y_lag1", "q_now").where("q_now IS NOT NULL")


@register("l4_fit_delta_by_group", sql("predictions", f"""
, t AS (SELECT *, weekofyear(date) * 1e0 AS week, lag(y) OVER (PARTITION BY zone, horizon ORDER BY row_id) AS q_now FROM predictions)
, f AS (SELECT zone, horizon, count(*) AS n, regr_intercept(y - q_now, week) AS a, regr_slope(y - q_now, week) AS b FROM t WHERE split = 'train' AND y > 0 AND q_now IS NOT NULL GROUP BY 1, 2)
, e AS (SELECT t.zone, t.horizon, avg(abs(y - greatest(q_now + a + b * week, 0e0))) AS mae FROM t JOIN f ON f.zone = t.zone AND f.horizon = t.horizon WHERE split = 'test' AND y > 0 AND q_now IS NOT NULL GROUP BY 1, 2)
SELECT zone, horizon, n, {rd('a', 'intercept', 2)}, {rd('b', 'slope', 2)}, {rd('mae', 'mae', 2)} FROM f LEFT JOIN e USING (zone, horizon)"""))
def l4_fit_delta_by_group(spark, sf_dir):
    x = deltas(spark, sf_dir)
    fits = grouped_models.fit_delta(x.where("split = 'train'"), ZH, ["week"], "y", "q_now")
    test = grouped_models.predict_delta(x.where("split = 'test' AND y > 0"), fits, ZH, ["week"], "q_now")
    errors = test.groupBy(*ZH).agg(F.avg(F.abs(F.col("y") - F.col("m"))).alias("mae"))
    return tidy(fits.join(errors, ZH, "left").select(*ZH, "n", F.col("coef")[0].alias("intercept"), F.col("coef")[1].alias("slope"), "mae"), 2)


@register("l5_tune")
def l5_tune(spark, sf_dir):
    return tidy(models.tune(training(spark, sf_dir).where("y > 0"), FEATURES, "y", "row_id"), 3)


@register("l8_ridge_stack")
def l8_ridge_stack(spark, sf_dir):
    x = training(spark, sf_dir)
    out = models.ridge_stack(x.where("split = 'calib'"), x.where("split = 'test'"), ["m1", "m2"], "y")
    return out.select("row_id", F.round("stacked", 3).alias("stacked"))


def pixel_rows(spark, sf_dir) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    bands = [F.get("embedding", F.lit(i)).cast("double").alias(b) for i, b in enumerate(BANDS)]
    return e.select("vec_id", "label", *bands, (F.col("vec_id") % 5 != 0).alias("inside"))


BANDS = [f"b{i}" for i in range(64)]


@register("l12_fit_pixel_classifier")
def l12_fit_pixel_classifier(spark, sf_dir):
    """F1 per class on the held-out fifth, by the setting that cross-validation chose."""
    _, setting, scores = models.select_pixel_classifier(pixel_rows(spark, sf_dir), BANDS, "label", "vec_id")
    return tidy(scores.select("class", "support", "f1", *[F.lit(v).alias(k) for k, v in setting.items()]))


@register("l13_classify_pixels")
def l13_classify_pixels(spark, sf_dir):
    x = pixel_rows(spark, sf_dir)
    model = models.fit_pixel_classifier(x.where("vec_id % 5 <> 1"), BANDS, "label")
    return models.classify_pixels(model, x, BANDS, "inside").select("vec_id", "klass")


@register("l14_feature_importance")
def l14_feature_importance(spark, sf_dir):
    model = models.fit_pixel_classifier(pixel_rows(spark, sf_dir), BANDS, "label")
    return models.feature_importance(model, BANDS, spark)


@register("a39_importance_by_group")
def a39_importance_by_group(spark, sf_dir):
    model = models.fit_pixel_classifier(pixel_rows(spark, sf_dir), BANDS, "label")
    x = models.feature_importance(model, BANDS, spark).withColumn("prefix", F.regexp_extract("feature", "^(b1?)", 1))
    return x.groupBy("prefix").agg(F.round(F.sum("importance"), 6).alias("importance"), F.count(F.lit(1)).alias("features"))


