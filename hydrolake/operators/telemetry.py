"""Telemetry: hourly and daily tables, gaps, arrival order, snapshots, and the daily reservoir balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrolake.functions import scalar as S
from hydrolake.operators import lookups, ranges

def hourly_resample(df: DataFrame, by: Sequence[str], ts: str, last_cols: Sequence[str], mean_cols: Sequence[str]) -> DataFrame:
    """Per hour the last non-null of some columns, the mean of others and the count; hours without readings are kept."""
    per = df.groupBy(*by, F.date_trunc("hour", ts).alias("hour")).agg(
        *[F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(ts))).alias(c) for c in last_cols],
        *[F.avg(c).alias(c) for c in mean_cols], F.count(F.lit(1)).alias("n_readings"),
    )
    spine = df.groupBy(*by).agg(F.date_trunc("hour", F.min(ts)).alias("a"), F.date_trunc("hour", F.max(ts)).alias("b"))
    spine = spine.select(*by, F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    out = spine.join(per, [*by, "hour"], "left").withColumn("n_readings", F.coalesce("n_readings", F.lit(0).cast("long")))
    return out.withColumn("is_gap", F.col("n_readings") == 0)


def accept_monotonic(df: DataFrame, by: Sequence[str], order: str, ts: str, limit_h: float = 1.0) -> DataFrame:
    """In arrival order a reading is stored iff its time is after all stored before; hours since the last stored one.

    The greatest time before a row is the last stored one: a rejected reading isn't greater than it.
    """
    hours = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("_before").cast("timestamp"))) / 3.6e9
    x = ranges.running_before(df.withColumn("_time", F.col(ts)), by, order, {"_time": "max"}).withColumnRenamed("_time_before", "_before").drop("_time")
    out = x.withColumn("stored", F.col("_before").isNull() | (F.col(ts) > F.col("_before")))
    return out.withColumn("gap_hours", F.when(F.col("_before").isNotNull(), hours)).withColumn("gap_flag", F.coalesce(F.col("stored") & S.gap_flag("gap_hours", limit_h), F.lit(False))).drop("_before")


def day_of_mark(mark: str = "mark") -> Column:
    """Hour marks 08:00 to 07:00 belong to the day of that 07:00."""
    return F.to_date(F.col(mark) + F.expr("INTERVAL 16 HOUR"))


def daily_telemetry(marks: DataFrame, by: Sequence[str], level: str = "level", rain: str = "rain", fill: bool = False) -> DataFrame:
    """24 hour marks that end at 07:00: the level there (fill: else the day's last known one), rain over found marks, marks
    found, and whether the day is complete."""
    at7 = F.hour("mark") == 7
    known = F.col(level).isNotNull()
    last = F.max_by(F.when(known, F.col(level)), F.when(known, F.col("mark")))
    at_seven = F.max(F.when(at7, F.col(level)))
    out = marks.withColumn("date", day_of_mark()).groupBy(*by, "date").agg(
        (F.coalesce(at_seven, last) if fill else at_seven).alias("level_msl"), F.sum(F.coalesce(F.col(rain), F.lit(0.0))).alias("rain_24h_mm"), F.count(F.lit(1)).alias("hours_covered")
    )
    return out.withColumn("data_complete", (F.col("hours_covered") == 24) & F.col("level_msl").isNotNull())


def locf(df: DataFrame, by: Sequence[str], order: str, col: str) -> DataFrame:
    """The last known value carried forward; rows before the first known one are left out."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(col, F.last(col, ignorenulls=True).over(w)).where(F.col(col).isNotNull())


def filled_hours(marks: DataFrame, by: Sequence[str], level: str = "level") -> DataFrame:
    """The 24 marks of each day with the day's last known level carried forward (leading gaps left out)."""
    days = marks.withColumn("date", day_of_mark()).select(*by, "date").distinct()
    first = F.col("date").cast("timestamp_ntz") - F.expr("INTERVAL 16 HOUR")
    spine = days.withColumn("mark", F.explode(F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: first + F.make_dt_interval(F.lit(0), h))))
    own = marks.withColumn("mark", F.col("mark").cast("timestamp_ntz")).select(*by, "mark", level)
    return locf(spine.join(own, [*by, "mark"], "left"), [*by, "date"], "mark", level)


def spill_daily(hours: DataFrame, by: Sequence[str], level: str = "level", strict: bool = False, **weir) -> DataFrame:
    """Cubic metres over the weir per day from filled hourly levels. strict: not 24 hours is an error."""
    out = hours.groupBy(*by, "date").agg(F.sum(S.weir_flow(level, **weir) * 3600).alias("spill_m3"), F.count(F.lit(1)).alias("hours_filled"))
    if strict:
        out = out.withColumn("spill_m3", F.when(F.col("hours_filled") != 24, F.raise_error(F.lit("not 24 hours")).cast("double")).otherwise(F.col("spill_m3")))
    return out


def water_balance_daily(daily: DataFrame, curve: DataFrame, spill: DataFrame, release: DataFrame, by: Sequence[str] = ("station",), infiltration_mm: float = 1.0, days_mode: str = "real") -> DataFrame:
    """Inflow of days whose day before is known: max(0, dS - rain + release + spill + evaporation + infiltration)."""
    known = daily.where(F.col("level_msl").isNotNull())
    at = lookups.floor_lookup(known, curve, ["area_m2", "storage_m3"], by, "level_msl")
    w = Window.partitionBy(*by).orderBy("date")
    at = at.withColumn("prev_storage_m3", F.when(F.lag("date").over(w) == F.date_sub("date", 1), F.lag("storage_m3").over(w)))
    x = at.where(F.col("prev_storage_m3").isNotNull()).join(spill.select(*by, "date", "spill_m3"), [*by, "date"], "left").join(release.select(*by, "date", "release_m3"), [*by, "date"], "left")
    zero = F.lit(0.0)
    x = x.withColumns({
        "spill_m3": F.coalesce("spill_m3", zero), "release_m3": F.coalesce("release_m3", zero), "delta_s_m3": F.col("storage_m3") - F.col("prev_storage_m3"),
        "rain_m3": F.col("area_m2") * F.col("rain_24h_mm") / 1000, "evap_m3": F.col("area_m2") * S.evaporation_mm("date", days_mode=days_mode) / 1000, "infiltration_m3": F.col("area_m2") * infiltration_mm / 1000,
    })
    raw = F.col("delta_s_m3") - F.col("rain_m3") + F.col("release_m3") + F.col("spill_m3") + F.col("evap_m3") + F.col("infiltration_m3")
    return x.withColumn("inflow_raw_m3", raw).withColumn("inflow_m3", F.greatest(zero, F.col("inflow_raw_m3")))


def latest_per_station(df: DataFrame, by: Sequence[str], field: str, order: str, ts: str, value: str) -> DataFrame:
    """Per field the last non-missing value in log order and its time."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, field).agg(F.max_by(value, order).alias("value"), F.max_by(ts, order).alias("ts"))


def station_snapshot(levels: DataFrame, curve: DataFrame, spillway: float, by: str = "station") -> DataFrame:
    """Storage now and at the spillway, % of capacity and distance to the spillway; null where the level is missing."""
    now = lookups.interp_lookup(levels, curve, "storage_m3", (by,), "level", name="storage_now")
    full = lookups.interp_lookup(levels.select(by).distinct().withColumn("level", F.lit(spillway)), curve, "storage_m3", (by,), "level", name="storage_full").select(by, "storage_full")
    x = now.join(full, by)
    return x.withColumns({"storage_now": F.when(F.col("level").isNotNull(), F.col("storage_now")), "to_spillway": F.round(F.lit(spillway) - F.col("level"), 3)}).withColumn("pct_full", F.round(100 * F.col("storage_now") / F.col("storage_full"), 2))


def station_history(readings: DataFrame, by: str, ts: str, fields: Sequence[str], hours: int) -> DataFrame:
    """The nearest reading at each hour back from the latest, oldest first."""
    end = readings.groupBy(by).agg(F.date_trunc("hour", F.max(ts)).alias("_end"))
    near = lookups.nearest_join(readings, [by], ts, fields)
    back = F.expr(f"INTERVAL {hours} HOUR")
    return near.join(end, by).where((F.col("mark") <= F.col("_end")) & (F.col("mark") > F.col("_end") - back)).drop("_end")


def fill_or_flag_gap(hourly: DataFrame, by: Sequence[str], hour: str, col: str, short: int = 2, rain: str | None = None, rain_limit: float = 0.0, day: Column | None = None) -> DataFrame:
    """``hourly`` (a row per key and hour, gaps as nulls in ``col``) with filled, interpolated, gap_status and data_gap_day.

    A gap of up to ``short`` hours between known ones is interpolated. A longer one, one without a known hour on either
    side, and one with rain (over ``rain_limit`` in its hours or the known ones next to it, as the level may have moved
    between) isn't guessed: each day that it touches is left out whole, its hours have no filled value. ``day`` says which
    day an hour belongs to (default: its date). gap_status: ok, interpolated, or data_gap_day.
    """
    keys = list(by)
    back = Window.partitionBy(*keys).orderBy(hour).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(hour).rowsBetween(0, Window.unboundedFollowing)
    missing = F.col(col).isNull()
    wet = F.coalesce(F.col(rain), F.lit(0.0)) if rain else F.lit(0.0)
    x = hourly.withColumns({"_n": F.row_number().over(Window.partitionBy(*keys).orderBy(hour)), "_rain": wet, "_day": F.to_date(hour) if day is None else day})
    known = F.when(~missing, F.struct(F.col("_n").alias("n"), F.col(col).alias("v"), F.col("_rain").alias("r")))
    x = x.withColumns({"_a": F.last(known, True).over(back), "_b": F.first(known, True).over(ahead)})
    # a gap's hours and the known hour before them share that hour's number
    most = F.greatest(F.max("_rain").over(Window.partitionBy(*keys, "_a.n")), F.col("_b.r"))
    fits = (F.col("_b.n") - F.col("_a.n") - 1 <= short) & (most <= rain_limit)
    x = x.withColumn("_long", missing & ~F.coalesce(fits, F.lit(False)))
    x = x.withColumn("data_gap_day", F.max("_long").over(Window.partitionBy(*keys, "_day")))
    line = F.col("_a.v") + (F.col("_n") - F.col("_a.n")) / (F.col("_b.n") - F.col("_a.n")) * (F.col("_b.v") - F.col("_a.v"))
    out = x.withColumns({
        "interpolated": missing & ~F.col("data_gap_day"), "filled": F.when(F.col("data_gap_day"), F.lit(None)).when(missing, line).otherwise(F.col(col)),
        "gap_status": F.when(F.col("data_gap_day"), "data_gap_day").when(missing, "interpolated").otherwise("ok"),
    })
    return out.drop("_n", "_rain", "_day", "_a", "_b", "_long")
