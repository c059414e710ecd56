"""Feature tables: columns, medians, scaling, matrices, readiness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrolake.functions import scalar as S
from hydrolake.operators import lookups, ranges, series


def null_columns(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per key the columns that are null throughout: one pass."""
    counts = df.groupBy(*by).agg(*[F.count(c).alias(c) for c in cols])
    return counts.select(*by, F.array_compact(F.array(*[F.when(F.col(c) == 0, F.lit(c)) for c in cols])).alias("dropped"))


def drop_all_null_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    return df.drop(*[c for c in cols if not counts[c]])


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fail on a missing column."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def complete_rows(df: DataFrame, targets: Sequence[str], day: str, excluded: Sequence[str] = (), prefix: str | None = None) -> DataFrame:
    """Rows with all targets and the date; features by exclusion and by a name's prefix."""
    good = require(df, [*targets, day]).dropna(subset=[*targets, day])
    features = [c for c in df.columns if c not in (*targets, day, *excluded) and (prefix is None or c.startswith(prefix))]
    return good.select(day, *features, *targets)


def plausible_rows(cols: Sequence[str], pct_full: str, most: float = 105.0) -> Column:
    good = F.col(pct_full) <= most
    for c in cols:
        good = good & F.col(c).isNotNull()
    return F.coalesce(good, F.lit(False))


def scale_min_max(train: DataFrame, rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fit on one table, apply to another; a constant column becomes 0. The fitted row is one row, so it's broadcast."""
    fitted = train.agg(*[F.min(c).alias(f"_min_{c}") for c in cols], *[F.max(c).alias(f"_max_{c}") for c in cols]).first()
    lo, hi = {c: fitted[f"_min_{c}"] for c in cols}, {c: fitted[f"_max_{c}"] for c in cols}
    return rows.withColumns({c: (F.col(c) - lo[c]) / (hi[c] - lo[c]) if hi[c] is not None and hi[c] > lo[c] else F.when(F.col(c).isNotNull(), 0.0) for c in cols})


def impute_sentinel(df: DataFrame, cols: Sequence[str], sentinel: float = -9999.0) -> DataFrame:
    """Sentinel to null to the column's exact median to 0."""
    middle = {}
    for c in cols:
        found = ranges.exact_quantile(df.select(F.nullif(F.col(c), F.lit(sentinel)).alias(c)), [], c, F.lit(0.5)).first()
        middle[c] = found["q"] if found else None
    return df.withColumns({c: S.impute(c, sentinel, F.lit(middle[c]).cast("double")) for c in cols})


def quality_checks(df: DataFrame) -> DataFrame:
    """Counts of rule violations, one row per rule, with a pass flag."""
    rules = {"et0_negative": F.col("et0") < 0, "rain_negative": F.col("rain") < 0, "p_eff_over_rain": F.col("p_eff") > F.col("rain") + 0.01, "aridity_over_10": F.col("aridity") > 10, "spi_missing": F.col("spi4").isNull(), "imputed": F.col("imputed") == 1}
    x = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in rules)
    out = x.select(F.expr(f"stack({len(rules)}, {pairs}) AS (rule, n)"))
    return out.withColumn("passed", (F.col("n") == 0) | (F.col("rule") == "imputed"))


def week_month_join(weekly: DataFrame, index: DataFrame) -> DataFrame:
    """Weeks with the monthly index of their Monday's month."""
    x = weekly.withColumn("week_start", S.week_start("iso_year", "iso_week"))
    return x.withColumns({"year": F.year("week_start"), "month": F.month("week_start")}).join(index, ["year", "month"], "left")


def feature_matrix(demand: DataFrame, climate: DataFrame, index: DataFrame, by: Sequence[str] = ("zone",), horizons: int = 12) -> DataFrame:
    """Demand, climate and index per week with seasons, cycles, row lags, rolling statistics and leads."""
    keys = [*by, "iso_year", "iso_week"]
    order = ["iso_year", "iso_week"]
    x = lookups.drop_overlap_join(demand, climate, keys)
    x = series.interpolate_fill(week_month_join(x, index), by, order, "mei").withColumnRenamed("p_eff", "effective_rain")
    ws, wc = S.cyclic("iso_week", 52)
    ms, mc = S.cyclic("month", 12)
    x = x.withColumns({"week_sin": ws, "week_cos": wc, "month_sin": ms, "month_cos": mc, "season_enc": S.season_code("iso_week")})
    for col, lags in (("target", (1, 2, 3, 4, 8, 12)), ("et0", (1, 2, 4)), ("rain", (1, 2, 4)), ("vpd", (1, 2)), ("mei", (4, 8))):
        x = series.row_lags(x, by, order, col, lags)
    x = series.rolling_prev(x, by, order, "target", (4, 8))
    return series.lead_targets(x, by, order, "target", horizons)


def readiness(live: DataFrame, trained: Sequence[str], by: Sequence[str]) -> DataFrame:
    """live if a key's filled feature list equals the training list, else static; and what is missing."""
    lacking = null_columns(live, by, [c for c in trained if c in live.columns])
    absent = F.array(*[F.lit(c) for c in trained if c not in live.columns]).cast("array<string>")
    x = lacking.withColumn("missing", F.array_join(F.array_sort(F.concat("dropped", absent)), ",")).drop("dropped")
    return x.withColumn("source", F.when(F.col("missing") == "", "live").otherwise("static"))


def align_union(tables: Sequence[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def daily_state(df: DataFrame, by: Sequence[str], full: float) -> DataFrame:
    """Storage change, % full, antecedent rain and validity per day; API follows the rows' order."""
    api = series.recursive_api(df, by, "date", "rain_24h_mm")
    x = df.join(api.select(*by, "date", "api"), [*by, "date"])
    x = x.withColumns({"pct_full": 100 * F.col("storage_m3") / full})
    x = series.row_lags(x, by, "date", "storage_m3", [1]).withColumn("delta_s", F.col("storage_m3") - F.col("storage_m3_lag1")).drop("storage_m3_lag1")
    return x.withColumn("valid", plausible_rows(["level_msl", "storage_m3", "delta_s", "rain_24h_mm", "api", "pct_full", "inflow_m3"], "pct_full"))
