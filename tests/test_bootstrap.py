"""Resamples draw in batches, not in a row for each row and replicate."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydrolake.operators import skill

PRIME = 2**31 - 1


def plain_draws(key, reps, seed):
    out = []
    for rep in range(1, reps + 1):
        h = (key * 48271 % PRIME + rep * 7919 + seed) % PRIME
        u = ((h * h % PRIME + 12345) ** 2 % PRIME) / (2**31 - 1.0)
        out.append(sum(u >= s for s in skill.poisson_steps(PRIME)))
    return out


def test_draws_are_those_of_the_hash():
    keys = [0, 1, 2, 48271, PRIME - 1, PRIME, 5 * 10**9]
    found = skill.poisson_draws(300, 5)(np.array([k * 48271 % PRIME for k in keys]))
    assert found.tolist() == [plain_draws(k, 300, 5) for k in keys]


def test_sums_per_key_and_replicate(spark):
    rows = [(k, "ab"[k % 2] if k % 5 else None, None if k % 7 == 0 else float(k % 11), 4.0) for k in range(2500)] + [(None, "a", 1.0, 1.0), (1, "c", None, 1.0)]
    df = spark.createDataFrame(rows, "k long, g string, y double, p double")
    out = skill.bootstrap_ci(df, ["g"], "k", "y", "p", reps=40)
    found = {r.g: (r.low, r.high) for r in out.collect()}
    for g in "ab":
        own = [(plain_draws(k, 40, 5), abs(p - y) if y is not None else None) for k, h, y, p in rows if h == g and k is not None]
        stats = [sum(d[i] * e for d, e in own if e is not None) / sum(d[i] for d, _ in own) for i in range(40)]
        assert found[g] == pytest.approx((np.quantile(stats, 0.025), np.quantile(stats, 0.975)))
    assert found["c"] == (None, None) and set(found) == {"a", "b", "c"}  # a key that is null meets no point


def test_rows_are_summed_before_replicates_are_told_apart(spark):
    df = spark.range(20000).select(F.col("id").alias("k"), F.lit("a").alias("g"), F.lit(1.0).alias("y"), F.lit(3.0).alias("p"))
    plan = skill.bootstrap_ci(df.coalesce(1), ["g"], "k", "y", "p")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("MapInArrow")  # the replicates are told apart above the batches' sums
