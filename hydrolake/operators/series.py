"""Daily, weekly and monthly series: resampling, tiers, gaps, lags, rolling windows, splits."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolake.functions import scalar as S
from hydrolake.operators import ranges

#: Tiers of rain, best first.
TIERS = ("final", "prelim_ftp", "prelim")


def _ordered(by: Sequence[str], order: str | Sequence[str]) -> Window:
    return Window.partitionBy(*by).orderBy(*([order] if isinstance(order, str) else order))


def tier_rank(tier: str = "data_type") -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, TIERS)), F.col(tier)), F.lit(0)), F.lit(99))


def weekly_rain(daily: DataFrame, by: Sequence[str] = ("zone",)) -> DataFrame:
    """Per ISO week: rain, days, and the worst tier in it."""
    weeks = daily.groupBy(*by, S.iso_year("date").alias("iso_year"), S.iso_week("date").alias("iso_week"))
    out = weeks.agg(F.sum("precipitation").alias("rain"), F.count(F.lit(1)).alias("n_days"), F.max(tier_rank()).alias("_worst"))
    return out.withColumn("data_type", F.when(F.col("_worst") == 1, "final").when(F.col("_worst") == 2, "prelim_ftp").otherwise("prelim")).drop("_worst")


def weekly_weather(daily: DataFrame, sums: Sequence[str], means: Sequence[str], by: Sequence[str] = ("zone",), days: int = 7) -> DataFrame:
    """Per ISO week sums and means, whole weeks only."""
    weeks = daily.groupBy(*by, S.iso_year("date").alias("iso_year"), S.iso_week("date").alias("iso_week"))
    out = weeks.agg(*[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in means], F.count(F.lit(1)).alias("n_days"))
    return out.where(F.col("n_days") == days)


def spatial_mean(grid: DataFrame, by: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Means over cells; a day without one of the required variables is left out."""
    out = grid.groupBy(*by).agg(*[F.avg(c).alias(c) for c in required])
    return out.dropna(subset=list(required))


def climatology(weekly: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return weekly.groupBy(*by).agg(*[F.percentile(c, F.lit(0.5)).alias(c) for c in cols])


def week_calendar(weekly: DataFrame, by: Sequence[str], weeks: int = 52) -> DataFrame:
    """All years of a key x weeks 1 to ``weeks``."""
    years = weekly.groupBy(*by).agg(F.min("iso_year").alias("a"), F.max("iso_year").alias("b"))
    years = years.select(*by, F.explode(F.sequence("a", "b")).alias("iso_year"))
    return years.withColumn("iso_week", F.explode(F.sequence(F.lit(1), F.lit(weeks))))


def impute_weeks(weekly: DataFrame, cols: Sequence[str], by: Sequence[str] = ("zone",)) -> DataFrame:
    """Missing weeks of the calendar get the median of their week of the year (3 decimals), 0 without one, and a mark."""
    keys = [*by, "iso_year", "iso_week"]
    missing = week_calendar(weekly, by).join(weekly.select(*keys), keys, "left_anti")
    middle = climatology(weekly, [*by, "iso_week"], cols)
    filled = missing.join(middle, [*by, "iso_week"], "left").select(*keys, *[F.coalesce(F.round(c, 3), F.lit(0.0)).alias(c) for c in cols], F.lit(1).alias("imputed"))
    return weekly.select(*keys, *cols, F.lit(0).alias("imputed")).unionByName(filled)


def rolling_sum(df: DataFrame, by: Sequence[str], order, col: str, n: int, name: str) -> DataFrame:
    """This row and the n-1 before; null until n non-null values."""
    w = _ordered(by, order).rowsBetween(-(n - 1), 0)
    return df.withColumn(name, F.when(F.count(col).over(w) == n, F.sum(col).over(w)))


def spi4(weekly: DataFrame, by: Sequence[str] = ("zone",), rain: str = "rain", nan_policy: str = "propagate") -> DataFrame:
    """Standardised 4-week rain: z-score (sample deviation) within the week of the year, 3 decimals; drought below -1.

    A group of one gives 0. propagate: a group that holds a missing sum gives 0 throughout; omit: only that row.
    """
    x = rolling_sum(weekly, by, ["iso_year", "iso_week"], rain, 4, "rain4")
    w = Window.partitionBy(*by, "iso_week")
    z = (F.col("rain4") - F.avg("rain4").over(w)) / F.nullif(F.stddev_samp("rain4").over(w), F.lit(0.0))
    if nan_policy == "propagate":
        z = F.when(F.count("rain4").over(w) == F.count(F.lit(1)).over(w), z)
    return x.withColumn("spi4", F.round(F.coalesce(z, F.lit(0.0)), 3)).withColumn("drought_flag", F.when(F.col("spi4") < -1, 1).otherwise(0))


def row_lags(df: DataFrame, by: Sequence[str], order, col: str, lags: Sequence[int]) -> DataFrame:
    w = _ordered(by, order)
    return df.withColumns({f"{col}_lag{k}": F.lag(col, k).over(w) for k in lags})


def rolling_prev(df: DataFrame, by: Sequence[str], order, col: str, windows: Sequence[int]) -> DataFrame:
    """Mean and sample deviation of the w rows before; null until w non-null values."""
    out = {}
    for n in windows:
        w = _ordered(by, order).rowsBetween(-n, -1)
        full = F.count(col).over(w) == n
        out |= {f"{col}_mean{n}": F.when(full, F.avg(col).over(w)), f"{col}_std{n}": F.when(full, F.stddev_samp(col).over(w))}
    return df.withColumns(out)


def calendar_roll(df: DataFrame, by: Sequence[str], week: str, col: str, n: int) -> DataFrame:
    """Mean and sample deviation over the n calendar weeks before; null if one is missing."""
    index = (F.datediff(F.col(week), F.lit("1970-01-05").cast("date")) / 7).cast("long")
    w = Window.partitionBy(*by).orderBy("_w").rangeBetween(-n, -1)
    full = F.count(col).over(w) == n
    return df.withColumn("_w", index).withColumns({f"{col}_mean{n}": F.when(full, F.avg(col).over(w)), f"{col}_std{n}": F.when(full, F.stddev_samp(col).over(w))}).drop("_w")


def lead_targets(df: DataFrame, by: Sequence[str], order, col: str, horizons: int) -> DataFrame:
    """y_h1 .. y_hH; rows where all are missing are left out."""
    w = _ordered(by, order)
    names = [f"y_h{h}" for h in range(1, horizons + 1)]
    return df.withColumns({n: F.lead(col, h).over(w) for h, n in enumerate(names, 1)}).dropna(how="all", subset=names)


def interpolate_fill(df: DataFrame, by: Sequence[str], order, col: str) -> DataFrame:
    """Linear by row position between known values; the tail holds the last, the head takes the first."""
    back = _ordered(by, order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = _ordered(by, order).rowsBetween(0, Window.unboundedFollowing)
    x = df.withColumn("_n", F.row_number().over(_ordered(by, order))).withColumn("_k", F.when(F.col(col).isNotNull(), F.col("_n")))
    x = x.withColumns({"_a": F.last(col, True).over(back), "_i": F.last("_k", True).over(back), "_b": F.first(col, True).over(ahead), "_j": F.first("_k", True).over(ahead)})
    line = F.col("_a") + (F.col("_n") - F.col("_i")) * (F.col("_b") - F.col("_a")) / F.nullif(F.col("_j") - F.col("_i"), F.lit(0))
    return x.withColumn(col, F.coalesce(F.col(col), line, F.col("_a"), F.col("_b"))).drop("_n", "_k", "_a", "_i", "_b", "_j")


def dedup_latest(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The newest row of each key, as a partial aggregate."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("x")).select(*key, "x.*")


def priority_dedup(df: DataFrame, key: Sequence[str], tier: str = "data_type") -> DataFrame:
    """The row of the best tier of each key (ties: the greatest row)."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max(F.struct((-tier_rank(tier)).alias("_r"), *rest)).alias("x"))
    return best.select(*key, *[F.col(f"x.{c}").alias(c) for c in rest])


def rolling_estimate(daily: DataFrame, by: Sequence[str], as_of: str, days: int = 7) -> DataFrame:
    """Rain of the ``days`` calendar days that end at the latest day with data up to ``as_of``."""
    known = daily.where(F.col("date") <= F.lit(as_of).cast("date"))
    end = known.groupBy(*by).agg(F.max("date").alias("_end"))
    inside = known.join(end, list(by)).where(F.col("date") > F.date_sub("_end", days))
    return inside.groupBy(*by).agg(F.sum("precipitation").alias("rain"), F.count(F.lit(1)).alias("n_days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


def latest_complete_row(df: DataFrame, by: Sequence[str], required: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in by]
    good = df.dropna(subset=list(required))
    return good.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("x")).select(*by, "x.*")


def complete_run() -> Column:
    """A run counts as complete with 7 of 7 days from both sources and no rolling estimate."""
    return (F.col("n_days_rain") == 7) & (F.col("n_days_weather") == 7) & ~F.col("is_rolling")


def incomplete_keys(log: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that have runs but never a complete one."""
    return log.groupBy(*key).agg(F.max(complete_run()).alias("_c")).where(~F.col("_c")).drop("_c")


def backfill_candidates(log: DataFrame, by: Sequence[str], as_of: str, most: int = 12, least_age: int = 14, per_run: int = 2) -> DataFrame:
    """Incomplete weeks, newest first, at most ``most`` a key; those of age are picked, ``per_run`` at most."""
    keys = incomplete_keys(log, [*by, "iso_year", "iso_week"])
    sunday = F.date_add(S.week_start("iso_year", "iso_week"), 6)
    x = keys.withColumn("age_days", F.datediff(F.lit(as_of).cast("date"), sunday))
    new = Window.partitionBy(*by).orderBy(F.col("iso_year").desc(), F.col("iso_week").desc())
    x = x.withColumn("rank", F.row_number().over(new)).where(F.col("rank") <= most)
    due = x.withColumn("_due", F.col("age_days") >= least_age)
    turn = F.sum(F.col("_due").cast("int")).over(new)
    return due.withColumn("decision", F.when(~F.col("_due"), "too_young").when(turn <= per_run, "picked").otherwise("later")).drop("_due")


def select_prediction_week(log: DataFrame, by: Sequence[str], as_of_year: int, as_of_week: int) -> DataFrame:
    """Newest complete week per key and how far it can be used: ok, fallback (an older week) or blocked (none)."""
    now = as_of_year * 100 + as_of_week
    code = F.col("iso_year") * 100 + F.col("iso_week")
    x = log.groupBy(*by).agg(F.max(F.when(complete_run() & (code <= now), code)).alias("week_code"))
    return x.withColumn("status", F.when(F.col("week_code").isNull(), "blocked").when(F.col("week_code") == now, "ok").otherwise("fallback"))


def sliding_windows(df: DataFrame, by: Sequence[str], order, col: str, n: int) -> DataFrame:
    """All windows of n consecutive rows as arrays; one with a missing value has none."""
    w = _ordered(by, order).rowsBetween(0, n - 1)
    x = df.withColumn("_all", F.count(F.lit(1)).over(w)).withColumn("window", F.collect_list(col).over(w)).where(F.col("_all") == n)
    return x.withColumn("no_data", F.size("window") < n).withColumn("window", F.when(~F.col("no_data"), F.col("window"))).drop("_all")


def chrono_split(df: DataFrame, by: Sequence[str], stratum: str, order: str, dry: str) -> DataFrame:
    """train/calib/test by order within strata with half-even rounding: cuts at 0.70n and 0.85n, or in the dry stratum
    0.70n and then another 0.15n rows."""
    keys = [*by, stratum]
    first = F.bround(0.70 * F.col("_n"), 0)
    second = F.when(F.col(stratum) == dry, first + F.bround(0.15 * F.col("_n"), 0)).otherwise(F.bround(0.85 * F.col("_n"), 0))
    x = ranges.with_count(ranges.numbered(df, keys, order, "_i"), keys, "_n")
    return x.withColumn("part", F.when(F.col("_i") <= first, "train").when(F.col("_i") <= second, "calib").otherwise("test")).drop("_n", "_i")


def ts_folds(df: DataFrame, by: Sequence[str], order: str, k: int) -> DataFrame:
    """Expanding folds: block = n // (k+1); fold i tests the block from n - (k-i+1) * block and trains on all before."""
    x = ranges.with_count(ranges.numbered(df, by, order, "_i"), by, "_n").withColumn("_b", (F.col("_n") / (k + 1)).cast("long"))
    x = x.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(k)))).withColumn("_from", F.col("_n") - (k - F.col("fold") + 1) * F.col("_b"))
    x = x.where(F.col("_i") <= F.col("_from") + F.col("_b"))
    return x.withColumn("role", F.when(F.col("_i") <= F.col("_from"), "train").otherwise("test")).drop("_b", "_n", "_i", "_from")


def stratified_folds(df: DataFrame, label: str, key: str, k: int, seed: int = 0) -> DataFrame:
    """Folds balanced per class, dealt in the order of a hash."""
    order, whole = ranges.hashed(key, seed)
    x = ranges.numbered(df.withColumns({"_o": order, "_h": whole}), [label], "_o", "_i", ["_h", key])
    return x.withColumn("fold", (F.col("_i") - 1) % k).drop("_o", "_h", "_i")


def match_rate_sample(df: DataFrame, by: Sequence[str], positive: str, key: str, rate: float, seed: int = 0) -> DataFrame:
    """All positives and as many negatives (by hash order) as give the rate."""
    order, whole = ranges.hashed(key, seed)
    want = df.groupBy(*by).agg(F.round(F.sum(F.col(positive).cast("int")) * (1 - rate) / rate).alias("_want"))
    x = ranges.numbered(df.withColumns({"_o": order, "_h": whole}), [*by, positive], "_o", "_rank", ["_h", key]).join(want, list(by))
    return x.where(F.col(positive) | (F.col("_rank") <= F.col("_want"))).drop("_want", "_rank", "_o", "_h")


def pentad_to_daily(df: DataFrame, start: str = "start", value: str = "value") -> DataFrame:
    """Five-day totals to days: from the 26th to the end of the month, else five days; an odd start is warned of."""
    d = F.day(start)
    last = F.when(d == 26, F.last_day(start)).otherwise(F.date_add(start, 4))
    x = df.withColumn("date", F.explode(F.sequence(F.col(start), last))).withColumn("odd_start", ~d.isin(1, 6, 11, 16, 21, 26))
    return x.withColumn(value, F.col(value) / (F.datediff(last, F.col(start)) + 1))


def week_skeleton(days: DataFrame, day: str, back: int) -> DataFrame:
    """The ISO weeks of the ``back`` + 1 weeks up to a day, with Monday and its month."""
    m = S.monday(day)
    x = days.withColumn("week_start", F.explode(F.sequence(F.date_sub(m, 7 * back), m, F.expr("INTERVAL 7 DAY"))))
    return x.withColumns({"iso_year": S.iso_year("week_start"), "iso_week": S.iso_week("week_start"), "year": F.year("week_start"), "month": F.month("week_start")}).distinct()


def candidate_days(days: DataFrame, day: str) -> DataFrame:
    """Days of the ISO week strictly before a day; on Mondays the 7 days before."""
    m = S.monday(day)
    first = F.when(m == F.col(day), F.date_sub(day, 7)).otherwise(m)
    return days.withColumn("candidate", F.explode(F.sequence(first, F.date_sub(day, 1))))


def tier_schedule(spans: DataFrame, by: Sequence[str], lag_days: int, start: str = "start", end: str = "end", today: str = "today") -> DataFrame:
    """``by``, date and the tiers to fetch, for each key's dates from start to end: final up to ``lag_days`` before its today,
    then prelim tiers."""
    days = spans.select(*by, F.col(today).alias("_today"), F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias("date"))
    final = F.col("date") <= F.date_sub("_today", lag_days)
    return days.withColumn("tiers", F.when(final, F.array(F.lit("final"))).otherwise(F.array(F.lit("prelim_ftp"), F.lit("prelim")))).drop("_today")


def recursive_api(df: DataFrame, by: Sequence[str], order: str, rain: str, k: float = 0.95) -> DataFrame:
    """Antecedent precipitation: API = k * API before + rain; the first is the rain; a missing rain gives a null and leaves
    the state. Columns: ``by``, ``order`` (distinct per key), ``rain``, api.

    A parallel scan: a range of a key's rows turns the state s before it into k^n * s + b (n: its rows with rain, b: its own
    fold from 0). Ranges are folded by themselves, a key's ranges are composed in order (as many as ``ranges`` cuts), and
    each row adds what is left of the state before its range.
    """
    keys = list(by)
    x = ranges.parted(df.select(*keys, order, F.col(rain).cast("double").alias("_r")), keys, order)

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable")
        state, n, states, ns = 0.0, 0, [], []
        for r in rows["_r"]:
            if r == r:
                state, n = k * state + r, n + 1
            states.append(state)
            ns.append(n)
        return rows.assign(_state=states, _n=ns)

    local = x.groupBy(*keys, "_part").applyInPandas(fold, T.StructType([*x.schema, *T.StructType.fromDDL("_state double, _n long")]))
    per = local.groupBy(*keys, "_part").agg(F.max_by("_state", order).alias("b"), F.max("_n").alias("n"))
    before = F.array_sort(F.collect_list(F.struct("_part", "b", "n")))
    power = lambda n: F.pow(F.lit(k), n)
    steps = per.groupBy(*keys).agg(before.alias("_steps"))
    start = F.struct(F.lit(0.0).alias("s"), F.array().cast("array<struct<_part:bigint,s0:double>>").alias("out"))
    walk = F.aggregate("_steps", start, lambda a, p: F.struct((power(p["n"]) * a["s"] + p["b"]).alias("s"), F.array_append(a["out"], F.struct(p["_part"].alias("_part"), a["s"].alias("s0"))).alias("out")))
    offsets = steps.select(*keys, F.explode(walk["out"]).alias("_o")).select(*keys, "_o._part", "_o.s0")
    api = F.when(F.col("_r").isNotNull(), F.col("_state") + power(F.col("_n")) * F.col("s0"))
    return local.join(offsets, [*keys, "_part"]).select(*keys, order, F.col("_r").alias(rain), api.alias("api"))
