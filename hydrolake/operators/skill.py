"""Forecast skill, thresholds, conformal intervals, two-stage and hurdle predictions. One grouping each, any number of keys."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from hydrolake.operators.ranges import exact_quantile, running_before

THRESHOLDS = tuple(round(0.15 + 0.025 * i, 3) for i in range(28))


def _safe(a, b) -> Column:
    return a / F.nullif(b, F.lit(0.0))


def prefix_sums(df: DataFrame, by: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """``df`` with <col>_before: the sum of each column over the key's rows with a lesser ``order`` (distinct per key)."""
    return running_before(df, by, order, dict.fromkeys(cols, "sum"))


def regression_metrics(y: str = "y", p: str = "p", eps: float = 0.0) -> dict[str, Column]:
    """MAE, RMSE, NSE, KGE, PBIAS, MAPE (on nonzero y) as aggregates; a zero denominator gives null, or eps is added."""
    e = F.col(p) - F.col(y)
    sst = F.count(y) * F.var_pop(y)
    sp, sy, mp, my = F.stddev_pop(p), F.stddev_pop(y), F.avg(p), F.avg(y)
    kge = 1 - F.sqrt(F.pow(_safe(F.covar_pop(p, y), sp * sy) - 1, 2) + F.pow(_safe(sp, sy) - 1, 2) + F.pow(_safe(mp, my) - 1, 2))
    return {
        "mae": F.avg(F.abs(e)), "rmse": F.sqrt(F.avg(e * e)), "nse": 1 - _safe(F.sum(e * e), sst + eps), "kge": F.when((sp > 0) & (sy > 0), kge),
        "pbias": 100 * _safe(F.sum(e), F.sum(y) + eps), "mape": 100 * F.avg(F.when(F.col(y) != 0, F.abs(e / F.col(y)))),
    }


def regression_skill(df: DataFrame, by: Sequence[str], y: str = "y", p: str = "p", eps: float = 0.0) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in regression_metrics(y, p, eps).items()])


def regime_skill(df: DataFrame, by: Sequence[str], y: str = "y", p: str = "p", dry_hit: float = 5000.0) -> DataFrame:
    """Errors on wet (y > 0) and dry rows, the share of dry rows predicted under ``dry_hit``, and F1 of the wet regime."""
    wet = F.col(y) > 0
    yw, e = F.when(wet, F.col(y)), F.col(p) - F.col(y)
    hit = F.col(p) >= dry_hit
    tp, fp, fn = F.count_if(wet & hit), F.count_if(~wet & hit), F.count_if(wet & ~hit)
    return df.groupBy(*by).agg(
        F.avg(F.when(wet, F.abs(e))).alias("wet_mae"), F.avg(F.when(~wet, F.abs(e))).alias("dry_mae"), (1 - _safe(F.sum(F.when(wet, e * e)), F.count_if(wet) * F.var_pop(yw))).alias("wet_nse"),
        (100 * F.avg(F.when(wet, F.abs(e / F.col(y))))).alias("wet_mape"), (100 * F.avg(F.when(~wet, F.when(F.col(p) < dry_hit, 1.0).otherwise(0.0)))).alias("zero_hit_pct"),
        (2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0))).alias("regime_f1"),
    )


def binary_skill(df: DataFrame, by: Sequence[str], positive: str, prob: str, threshold: float = 0.5) -> DataFrame:
    """Confusion counts, precision, recall, F1, zero hits, and the area under the ROC curve by rank sums.

    Ties share the mean rank. Ranks come from counts per distinct score, so equal scores cost one row.
    """
    pos, said = F.col(positive), F.col(prob) >= threshold
    tp, fp, fn, tn = F.count_if(pos & said), F.count_if(~pos & said), F.count_if(pos & ~said), F.count_if(~pos & ~said)
    counts = df.groupBy(*by).agg(
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"), (tp / F.nullif(tp + fp, F.lit(0))).alias("precision"), (tp / F.nullif(tp + fn, F.lit(0))).alias("recall"),
        (2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0))).alias("f1"), (tn / F.nullif(tn + fp, F.lit(0))).alias("zero_recall"),
    )
    per = df.groupBy(*by, prob).agg(F.count_if(pos).alias("a"), F.count_if(~pos).alias("b"))
    per = prefix_sums(per.where(F.col(prob).isNotNull()), by, prob, ["b"])
    auc = per.withColumn("_u", F.col("a") * (F.col("b_before") + F.col("b") / 2)).groupBy(*by).agg((F.sum("_u") / F.nullif(F.sum("a") * F.sum("b"), F.lit(0))).alias("auc"))
    return counts.join(auc, list(by))


def multiclass_skill(df: DataFrame, by: Sequence[str], y: str, p: str) -> DataFrame:
    """Per class precision, recall, F1 and support, from the confusion table."""
    table = df.groupBy(*by, y, p).agg(F.count(F.lit(1)).alias("n"))
    rows = table.select(*by, F.explode(F.array(F.struct(F.col(y).alias("_c"), F.col("n").alias("t"), F.lit(0).cast("long").alias("s"), F.when(F.col(y) == F.col(p), F.col("n")).otherwise(0).alias("h")), F.struct(F.col(p).alias("_c"), F.lit(0).cast("long").alias("t"), F.col("n").alias("s"), F.lit(0).cast("long").alias("h")))).alias("x")).select(*by, "x.*")
    out = rows.groupBy(*by, F.col("_c").alias("klass")).agg(F.sum("t").alias("support"), F.sum("s").alias("said"), F.sum("h").alias("hits"))
    return out.withColumns({"precision": F.col("hits") / F.nullif(F.col("said"), F.lit(0)), "recall": F.col("hits") / F.nullif(F.col("support"), F.lit(0)), "f1": 2 * F.col("hits") / F.nullif(F.col("said") + F.col("support"), F.lit(0))})


def multiclass_summary(per_class: DataFrame, by: Sequence[str]) -> DataFrame:
    f1 = F.coalesce("f1", F.lit(0.0))
    return per_class.groupBy(*by).agg((F.sum("hits") / F.sum("support")).alias("accuracy"), F.avg(f1).alias("macro_f1"), (F.sum(f1 * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def best_threshold(df: DataFrame, by: Sequence[str], positive: str, prob: str, grid: Sequence[float] = THRESHOLDS, default: float = 0.5) -> DataFrame:
    """The threshold of a fixed grid with the greatest F1 (the first of equals); the default if none hits.

    All thresholds are aggregates of one pass over the rows.
    """
    pos = F.col(positive)
    aggs = []
    for i, t in enumerate(grid):
        said = F.col(prob) >= t
        aggs.append((2 * F.count_if(pos & said) / F.nullif(F.count_if(pos) + F.count_if(said), F.lit(0))).alias(f"_f{i}"))
    x = df.groupBy(*by).agg(*aggs)
    options = F.array(*[F.struct(F.coalesce(F.round(f"_f{i}", 12), F.lit(0.0)).alias("f1"), F.lit(-t).alias("t")) for i, t in enumerate(grid)])
    best = F.array_max(options)
    return x.select(*by, F.when(best["f1"] > 0, -best["t"]).otherwise(default).alias("threshold"), best["f1"].alias("f1"))


def pr_threshold(df: DataFrame, by: Sequence[str], positive: str, prob: str) -> DataFrame:
    """The score with the greatest F1 over all distinct scores (of equals the highest score)."""
    per = df.groupBy(*by, prob).agg(F.count_if(F.col(positive)).alias("a"), F.count(F.lit(1)).alias("n"))
    per = prefix_sums(per.where(F.col(prob).isNotNull()), by, prob, ["a", "n"])
    per = per.join(per.groupBy(*by).agg(F.sum("a").alias("_a"), F.sum("n").alias("_n")), list(by))
    hits, said = F.col("_a") - F.col("a_before"), F.col("_n") - F.col("n_before")
    f1 = 2 * hits / F.nullif(said + F.col("_a"), F.lit(0))
    x = per.withColumn("_f1", F.coalesce(F.round(f1, 12), F.lit(0.0)))
    best = x.groupBy(*by).agg(F.max(F.struct("_f1", prob)).alias("x"))
    return best.select(*by, F.col(f"x.{prob}").alias("threshold"), F.col("x._f1").alias("f1"))


def inverse_error_weights(df: DataFrame, by: Sequence[str], y: str, a: str, b: str) -> DataFrame:
    """w_a = (1/MAE_a) / (1/MAE_a + 1/MAE_b), 4 decimals, and w_b = 1 - w_a."""
    x = df.groupBy(*by).agg(F.avg(F.abs(F.col(a) - F.col(y))).alias("mae_a"), F.avg(F.abs(F.col(b) - F.col(y))).alias("mae_b"))
    x = x.withColumn("w_a", F.round(F.col("mae_b") / F.nullif(F.col("mae_a") + F.col("mae_b"), F.lit(0.0)), 4))
    return x.withColumn("w_b", F.round(1 - F.col("w_a"), 4))


def best_per_group(df: DataFrame, by: Sequence[str], metric: str, name: str) -> DataFrame:
    """The row of the greatest metric; of equals the first name."""
    best = df.groupBy(*by).agg(F.min(F.struct((-F.col(metric)).alias("m"), name)).alias("x"))
    return best.select(*by, F.col(f"x.{name}").alias(name), (-F.col("x.m")).alias(metric))


def cv_stability(df: DataFrame, by: Sequence[str], metric: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("std"), F.count(metric).alias("folds"))


def poisson_steps(values: int) -> list[float]:
    """The chances of at most 0, 1, 2, ... events at rate 1, as far as a draw out of so many equal values can tell."""
    out, chance, k = [math.exp(-1)], math.exp(-1), 1
    while 1 - out[-1] > 1 / values:
        chance /= k
        out.append(out[-1] + chance)
        k += 1
    return out


_PRIME = 2**31 - 1


def poisson_draws(reps: int, seed: int) -> Callable[[np.ndarray], np.ndarray]:
    """What gives how often each of some keys comes in each of the replicates, a row per key. Tasks get it as a closure,
    as they may not have this package."""
    prime, shifts, least = _PRIME, np.arange(1, reps + 1) * 7919 + seed, []
    for s in poisson_steps(prime):
        at = math.floor(s * prime) - 1  # the least number that, divided by the prime as a double, is the step or more
        while at / prime < s:
            at += 1
        least.append(at)

    def square(x: np.ndarray) -> np.ndarray:
        x = x * x
        for _ in range(2):  # modulo 2^31 - 1: the bits above the 31st are added to those below
            x = (x & prime) + (x >> 31)
        return np.where(x >= prime, x - prime, x)

    def draws(keys: np.ndarray) -> np.ndarray:
        h = square(square(np.fmod(keys[:, None] + shifts, prime)) + 12345)
        times = np.zeros(h.shape, np.int8)
        for at in least:
            times += h >= at
        return times

    return draws


def _resampled(by: list[str], reps: int, seed: int, rows: int = 1000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per batch and key: sums of error times draws, of draws, and of draws with an error, per replicate."""
    draws = poisson_draws(reps, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code = np.zeros(batch.num_rows, np.int64)
            for c in by:
                one = batch.column(c).dictionary_encode(null_encoding="encode")
                code = np.unique(code * max(1, len(one.dictionary)) + one.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
            first = np.unique(code, return_index=True)[1]
            known = batch.column("_e").is_valid().to_numpy(zero_copy_only=False)
            e, keys = batch.column("_e").fill_null(0.0).to_numpy(), batch.column("_key").to_numpy()
            s, k, n = (np.zeros((len(first), reps), t) for t in (np.float64, np.int64, np.int64))
            order = np.argsort(code, kind="stable")
            for at in np.split(order, range(rows, len(order), rows)):
                times, (found, starts) = draws(keys[at]), np.unique(code[at], return_index=True)
                with np.errstate(invalid="ignore"):
                    s[found] += np.add.reduceat(np.where(times > 0, times * e[at][:, None], 0.0), starts, axis=0)
                k[found] += np.add.reduceat(times, starts, axis=0, dtype=np.int64)
                n[found] += np.add.reduceat(times * known[at][:, None], starts, axis=0, dtype=np.int64)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, reps, dtype=np.int32)), pa.array(m.ravel())) for m in (s, k, n)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(first)) for c in by], *lists], [*by, "_s", "_k", "_n"])

    return run


def bootstrap_ci(df: DataFrame, by: Sequence[str], key: str, y: str, p: str, reps: int = 200, alpha: float = 0.05, seed: int = 5) -> DataFrame:
    """Percentile interval of the mean absolute error from ``reps`` resamples.

    Each row draws how often it comes in each replicate from a hash (Poisson 1), so a resample needs no join and no row
    index. The hash squares modulo a prime, in whole numbers, so that any engine gets the same. A batch of rows draws for
    all replicates at once and gives a row of sums per key; those are added up by key and replicate.
    """
    err, of = F.abs(F.col(p) - F.col(y)), F.lit(_PRIME).cast("long")
    rows = df.select(*by, err.alias("_e"), (F.col(key).cast("long") % of * 48271 % of).alias("_key")).where("_key IS NOT NULL")
    sums = StructType([*rows.select(*by).schema.fields, *[StructField(c, ArrayType(t)) for c, t in (("_s", DoubleType()), ("_k", LongType()), ("_n", LongType()))]])
    x = rows.mapInArrow(_resampled(list(by), reps, seed), sums)
    x = x.select(*by, F.posexplode(F.arrays_zip("_s", "_k", "_n")).alias("rep", "x")).groupBy(*by, "rep").agg(*[F.sum(f"x.{c}").alias(c) for c in ("_s", "_k", "_n")])
    per = x.where("_k > 0").withColumn("stat", F.when(F.col("_n") > 0, F.col("_s") / F.col("_k")))
    ends = per.groupBy(*by).agg(F.percentile("stat", F.lit(alpha / 2)).alias("low"), F.percentile("stat", F.lit(1 - alpha / 2)).alias("high"))
    return ends.join(df.groupBy(*by).agg(F.avg(err).alias("point")), list(by))


def improvement(df: DataFrame, by: Sequence[str], model: str, base: str) -> DataFrame:
    return df.withColumn("improvement_pct", 100 * _safe(F.col(base) - F.col(model), F.col(base)))


def linear_validation(df: DataFrame, by: Sequence[str], x: str, y: str, least: int = 3) -> DataFrame:
    """Pearson r, slope, intercept, bias and RMSE of y on x; keys with under ``least`` pairs are left out."""
    e, slope = F.col(y) - F.col(x), _safe(F.covar_pop(x, y), F.var_pop(x))
    out = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), _safe(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias("r"), slope.alias("slope"), (F.avg(y) - slope * F.avg(x)).alias("intercept"), F.avg(e).alias("bias"), F.sqrt(F.avg(e * e)).alias("rmse")
    )
    return out.where(F.col("n") >= least)


def conformal_quantile(scores: DataFrame, by: Sequence[str], score: str, alpha: float = 0.1) -> DataFrame:
    """The linear-interpolated quantile at min(ceil((n+1)(1-alpha))/n, 1); no scores: infinity."""
    return exact_quantile(scores, by, score, F.least(F.ceil(F.round((F.col("n") + 1) * (1 - alpha), 9)) / F.col("n"), F.lit(1.0)))


def conformal_intervals(calib: DataFrame, test: DataFrame, by: Sequence[str], y: str, p: str, prob: str, threshold: float, variant: str = "D", alpha: float = 0.1, eps: float = 1000.0, least: int = 5) -> DataFrame:
    """Intervals p +/- q (A, B) or p +/- q * (p + eps) (C, D), the lower end at 0 at least; B and D by wet/dry regime.

    Calibration rows have the regime of y > 0, applied rows that of prob >= threshold; a regime of under ``least``
    scores takes the global quantile.
    """
    relative, regimes = variant in "CD", variant in "BD"
    err = F.abs(F.col(y) - F.col(p))
    scored = calib.withColumn("_s", err / (F.col(p) + eps) if relative else err).withColumn("regime", F.when(F.col(y) > 0, "wet").otherwise("dry"))
    overall = conformal_quantile(scored, by, "_s", alpha).select(*by, F.col("q").alias("_q0"))
    x = test.withColumn("regime", F.when(F.col(prob) >= threshold, "wet").otherwise("dry")).join(overall, list(by), "left")
    if regimes:
        own = conformal_quantile(scored, [*by, "regime"], "_s", alpha).where(F.col("n") >= least).select(*by, "regime", F.col("q").alias("_q1"))
        x = x.join(own, [*by, "regime"], "left").withColumn("q", F.coalesce("_q1", "_q0", F.lit(float("inf")))).drop("_q1")
    else:
        x = x.withColumn("q", F.coalesce("_q0", F.lit(float("inf"))))
    half = F.col("q") * (F.col(p) + eps) if relative else F.col("q")
    return x.withColumns({"low": F.greatest(F.lit(0.0), F.col(p) - half), "high": F.col(p) + half}).drop("_q0")


def coverage(df: DataFrame, by: Sequence[str], y: str = "y", low: str = "low", high: str = "high") -> DataFrame:
    inside = F.when(F.col(y).between(F.col(low), F.col(high)), 1.0).otherwise(0.0)
    width, wet = F.col(high) - F.col(low), F.col(y) > 0
    means = df.groupBy(*by).agg(
        F.avg(inside).alias("coverage"), F.avg(F.when(wet, inside)).alias("wet_coverage"), F.avg(F.when(~wet, inside)).alias("dry_coverage"),
        F.avg(width).alias("mean_width"), F.avg(F.when(wet, width)).alias("wet_width"),
    )
    middle = exact_quantile(df.withColumn("_width", width), by, "_width", F.lit(0.5), "median_width").drop("n")
    return means.join(middle, list(by), "left")


def two_stage(prob, m1, m2, w1, w2) -> Column:
    """p * max(w1 * m1 + w2 * m2, 0)."""
    return prob * F.greatest(w1 * m1 + w2 * m2, F.lit(0.0))


def hurdle(p_zero, threshold, now, delta, stale=None) -> Column:
    """0 if zero is likely, else max(now + delta, 0); null without a model or when stale."""
    value = F.when(p_zero >= threshold, 0.0).otherwise(F.greatest(now + delta, F.lit(0.0)))
    known = p_zero.isNotNull() & delta.isNotNull()
    return F.when(known & ~stale, value) if stale is not None else F.when(known, value)


def nearest_lag(horizon: int, lags: Sequence[int] = (1, 2, 3, 4, 8, 12)) -> int:
    """The lag next to a horizon; the first of equals."""
    return min(lags, key=lambda k: abs(k - horizon))


def benchmark_table(scores: DataFrame, baseline_model: str, metrics: Sequence[str]) -> DataFrame:
    """All models' metrics and one model's baseline columns as a row Persistence, 3 decimals."""
    own = scores.select("horizon", "model", *[F.round(m, 3).alias(m) for m in metrics])
    base = scores.where(F.col("model") == baseline_model).select("horizon", F.lit("Persistence").alias("model"), *[F.round(f"base_{m}", 3).alias(m) for m in metrics])
    return own.unionByName(base).orderBy("horizon", "model")


def win_counts(scores: DataFrame, by: Sequence[str], over: str, name: str, metric: str, target: float) -> DataFrame:
    """How many of ``over`` each name is best at (least metric), how many it is under the target, and its mean."""
    w = Window.partitionBy(*by, over)
    x = scores.withColumn("_best", F.min(metric).over(w))
    return x.groupBy(*by, name).agg(F.count_if(F.col(metric) == F.col("_best")).alias("wins"), F.count_if(F.col(metric) < target).alias("under_target"), F.avg(metric).alias("mean"))


def pipeline_status(steps: DataFrame, by: Sequence[str], state: str = "state") -> DataFrame:
    """Any blocked: blocked; any fallback: fallback; all failed: failed; some failed: partial; else ok."""
    any_ = lambda s: F.max(F.col(state) == s)
    x = steps.groupBy(*by).agg(any_("blocked").alias("b"), any_("fallback").alias("f"), any_("failed").alias("x"), F.min(F.col(state) == "failed").alias("all"))
    return x.select(*by, F.when(F.col("b"), "blocked").when(F.col("f"), "fallback").when(F.col("all"), "failed").when(F.col("x"), "partial").otherwise("ok").alias("status"))
