"""Ranges don't depend on how often a sketch is computed, nor on the order in which its parts are merged."""

import os

import pytest
from pyspark.sql import functions as F

from hydrolake.operators import ranges, series


@pytest.fixture
def moving_cuts(spark, monkeypatch):
    """Quantile sketches that differ each time they are computed, as they may where parts arrive in another order."""
    real = F.percentile_approx
    move = F.udf(lambda cuts: sorted(c + os.urandom(1)[0] for c in cuts), "array<long>").asNondeterministic()
    monkeypatch.setattr(ranges.F, "percentile_approx", lambda *a: move(real(*a)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # large tables: each use merges the sketch for itself
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbers_are_whole_if_sketches_differ(spark, moving_cuts):
    df = spark.range(20000).select(F.col("id").alias("row_id"), (F.col("id") % 2).alias("zone"))
    found = ranges.numbered(df, ["zone"], "row_id", "i").collect()
    assert len(found) == 20000 and all(r.i == r.row_id // 2 + 1 for r in found)


def test_folds_and_quantiles_if_sketches_differ(spark, moving_cuts):
    df = spark.range(6000).select(F.col("id").alias("row_id"), F.lit("A").alias("zone"))
    folds = series.ts_folds(df, ["zone"], "row_id", 5)
    assert {(r.fold, r.role): r["count"] for r in folds.groupBy("fold", "role").count().collect()} == {(f, r): 1000 * (f if r == "train" else 1) for f in range(1, 6) for r in ("train", "test")}
    assert ranges.exact_quantile(df, ["zone"], "row_id", F.lit(0.25)).first().q == 1499.75
