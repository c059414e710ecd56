"""Joins beyond equality: numeric and nearest as-of joins, interval joins, exact lookups, key-set joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrolake.operators import ranges
from hydrolake.sources.shared import fresh_path

TOLERANCE = 1e-9


def curve_intervals(curve: DataFrame, by: Sequence[str], level: str, cell: float) -> DataFrame:
    """Half-open intervals [_lo, _hi) between a curve's levels, with the next row's values, one row per cell they touch.

    Cells make the range join an equi-join: an interval of a curve touches few cells, a reading falls in one.
    """
    w = Window.partitionBy(*by).orderBy(level)
    values = [c for c in curve.columns if c not in by and c != level]
    out = curve.withColumns({"_lo": F.col(level), "_hi": F.lead(level).over(w), **{f"_next_{c}": F.lead(c).over(w) for c in values}})
    end = F.coalesce(F.col("_hi"), F.col("_lo"))
    return out.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_lo") / cell), F.floor(end / cell)))).drop(level)


def _at_level(df: DataFrame, curve: DataFrame, by: Sequence[str], level: str, curve_level: str, cell: float) -> DataFrame:
    """df with the interval its level falls in; levels beyond the curve are clamped to its ends."""
    ends = curve.groupBy(*by).agg(F.min(curve_level).alias("_least"), F.max(curve_level).alias("_most"))
    x = df.join(ends, list(by), "left").withColumn("_x", F.when(F.col(level).isNotNull(), F.least(F.greatest(F.col(level) + TOLERANCE, F.col("_least")), F.col("_most"))))
    x = x.withColumn("_cell", F.floor(F.col("_x") / cell))
    inside = (F.col("_x") >= F.col("i._lo")) & (F.col("i._hi").isNull() | (F.col("_x") < F.col("i._hi")))
    same = [F.col(f"x.{c}") == F.col(f"i.{c}") for c in by] + [F.col("x._cell") == F.col("i._cell")]
    cond: Column = inside
    for s in same:
        cond = cond & s
    rows = curve_intervals(curve, by, curve_level, cell)
    extra = [F.col(f"i.{c}") for c in rows.columns if c not in (*by, "_cell")]
    return x.alias("x").join(rows.alias("i"), cond, "left").select("x.*", *extra).drop("_cell", "_most")


def floor_lookup(df: DataFrame, curve: DataFrame, values: Sequence[str], by: Sequence[str] = ("station",), level: str = "level", curve_level: str = "level", strict: bool = False, cell: float = 0.05) -> DataFrame:
    """As-of join on a number: the curve row of the largest level <= level + 1e-9, clamped at both ends.

    strict: a level under the curve's least is an error.
    """
    found = _at_level(df, curve, by, level, curve_level, cell)
    cols = [F.col(v) for v in values]
    if strict:
        low = F.col(level) + TOLERANCE < F.col("_least")
        cols = [F.when(low, F.raise_error(F.lit("level is below the curve")).cast("double")).otherwise(F.col(v)).alias(v) for v in values]
    return found.select(*[F.col(c) for c in df.columns], *cols)


def interp_lookup(df: DataFrame, curve: DataFrame, value: str, by: Sequence[str] = ("station",), level: str = "level", curve_level: str = "level", cell: float = 0.05, name: str | None = None) -> DataFrame:
    """Piecewise linear between the curve's rows, clamped at both ends."""
    found = _at_level(df, curve, by, level, curve_level, cell)
    lo, hi, a, b = F.col("_lo"), F.col("_hi"), F.col(value), F.col(f"_next_{value}")
    x = F.least(F.greatest(F.col(level), F.col("_least")), F.coalesce(hi, lo))
    return found.select(*df.columns, F.when(hi.isNull(), a).otherwise(a + (x - lo) / (hi - lo) * (b - a)).alias(name or value))


def nearest_join(readings: DataFrame, by: Sequence[str], ts: str = "ts", fields: Sequence[str] = ("value",), tolerance_s: int = 1800) -> DataFrame:
    """Per hour mark the reading with the least distance within the tolerance (inclusive; ties: the earlier reading).

    A reading can serve the hour before and after it alone, so it's dealt to these two marks; the best per mark is a
    minimum of structs, which is partial before the shuffle.
    """
    if not 0 <= tolerance_s < 3600:
        raise ValueError("the tolerance must be under an hour")
    base = F.date_trunc("hour", F.col(ts))
    marks = readings.withColumn("mark", F.explode(F.array(base, base + F.expr("INTERVAL 1 HOUR"))))
    micros = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("mark").cast("timestamp"))
    near = marks.withColumn("_dist", F.abs(micros)).where(F.col("_dist") <= tolerance_s * 1_000_000)
    best = near.groupBy(*by, "mark").agg(F.min(F.struct("_dist", ts, *[f for f in fields if f != ts])).alias("_best"))
    return best.select(*by, "mark", F.col(f"_best.{ts}").alias(ts), *[F.col(f"_best.{f}").alias(f) for f in fields if f != ts])


def point_in_interval(days: DataFrame, events: DataFrame, by: Sequence[str], at: str = "ref_ts", start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """Each day's row with the events that cover its moment, both ends included; an open end still runs.

    Closed events are dealt to the dates they touch, so the join is on (keys, date); open ones to their start alone, joined
    by a range on the keys.
    """
    d, e = days.withColumn("_date", F.to_date(at)), events
    closed = e.where(F.col(end).isNotNull() & (F.col(end) >= F.col(start))).withColumn("_date", F.explode(F.sequence(F.to_date(start), F.to_date(end))))
    inside = (F.col(start) <= F.col(at)) & (F.col(at) <= F.col(end))
    first = d.join(closed, [*by, "_date"]).where(inside).drop("_date")
    still = d.drop("_date").join(e.where(F.col(end).isNull()), list(by)).where(F.col(start) <= F.col(at))
    return first.unionByName(still)


def covering_days(days: DataFrame, events: DataFrame, by: Sequence[str], at: str = "ref_ts", start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """``events`` with first_at and after_at: the first of the key's moments that they cover, and the first one after that
    they don't (null: none). Events that cover no moment are left out.

    Moments and both ends of the events are swept once, from the latest on, for the nearest moment that is still to come.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    path = fresh_path(events.sparkSession, "events")  # numbered once: a number must not change when rows are read again
    events.withColumn("_event", F.monotonically_increasing_id()).write.parquet(path)
    e = events.sparkSession.read.parquet(path)
    none = F.lit(None).cast("long")
    points = (
        days.select(*by, micros(at).alias("_t"), F.lit(1).alias("_kind"), none.alias("_event"))
        .unionByName(e.where(F.col(end).isNotNull()).select(*by, micros(end).alias("_t"), F.lit(0).alias("_kind"), "_event"))  # an end is inside, so a moment at it isn't after it
        .unionByName(e.select(*by, micros(start).alias("_t"), F.lit(2).alias("_kind"), "_event"))
        .withColumns({"_back": -F.col("_t"), "_moment": F.when(F.col("_kind") == 1, -F.col("_t"))})
    )
    swept = ranges.running_before(points, by, "_back", {"_moment": "max"}, ties=["_kind", "_event"]).where("_kind <> 1")
    found = swept.groupBy("_event").agg(F.max(F.when(F.col("_kind") == 2, -F.col("_moment_before"))).alias("_first"), F.max(F.when(F.col("_kind") == 0, -F.col("_moment_before"))).alias("_after"))
    found = found.where("_first IS NOT NULL AND (_after IS NULL OR _first < _after)")
    time = lambda c: F.timestamp_micros(c).cast(days.schema[at].dataType)
    return e.join(found, "_event").withColumns({"first_at": time("_first"), "after_at": time("_after")}).drop("_event", "_first", "_after")


def sweep_intervals(days: DataFrame, events: DataFrame, by: Sequence[str], value: str, number: str, at: str = "ref_ts", start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """``days`` (a row per key and moment) with total (of ``value`` over the events that cover the moment, both ends
    included; an open end still runs), n_open, and what changed since the key's moment before: opened and closed, the
    sorted numbers of the events that began and ceased to cover.

    An event adds its value at the first moment it covers and takes it away at the first after; the rest is a running sum
    over ranges of time. So work and result grow with moments plus events, however long events stay open; the
    events that cover a moment are those opened up to it without those closed.
    """
    e = events.select(*by, start, end, F.col(value).alias("_v"), F.col(number).alias("_n"))
    c = covering_days(days.select(*by, at), e, by, at, start, end)
    ends = c.select(*by, F.explode(F.array(F.struct(F.col("first_at").alias("t"), F.lit(1).alias("d")), F.struct(F.col("after_at").alias("t"), F.lit(-1).alias("d")))).alias("p"), "_v", "_n").where("p.t IS NOT NULL")
    opens = F.col("p.d") == 1
    change = ends.groupBy(*by, F.col("p.t").alias(at)).agg(
        F.sum(F.col("p.d") * F.col("_v")).alias("_dv"), F.sum("p.d").cast("long").alias("_dn"),
        F.array_sort(F.collect_list(F.when(opens, F.col("_n")))).alias("opened"), F.array_sort(F.collect_list(F.when(~opens, F.col("_n")))).alias("closed"),
    )
    none = F.array().cast(change.schema["opened"].dataType)
    x = days.join(change, [*by, at], "left").withColumns({"_dv": F.coalesce("_dv", F.lit(0.0)), "_dn": F.coalesce("_dn", F.lit(0).cast("long")), "opened": F.coalesce("opened", none), "closed": F.coalesce("closed", none)})
    x = x.withColumn("_at", F.unix_micros(F.col(at).cast("timestamp")))
    x = ranges.running_before(x, by, "_at", {"_dv": "sum", "_dn": "sum"})
    n = F.col("_dn_before") + F.col("_dn")
    total = F.when(n == 0, F.lit(0.0)).otherwise(F.col("_dv_before") + F.col("_dv"))
    return x.withColumns({"total": total, "n_open": n}).drop("_at", "_dv", "_dn", "_dv_before", "_dn_before")


def interval_overlap(events: DataFrame, until: str, start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """One row per event and day it touches, with the overlap in hours; open events run until ``until`` (a literal time)."""
    e = events.withColumn("_end", F.coalesce(F.col(end), F.lit(until).cast("timestamp_ntz"))).where(F.col("_end") >= F.col(start))
    e = e.withColumn("day", F.explode(F.sequence(F.to_date(start), F.to_date("_end"))))
    day = F.col("day").cast("timestamp_ntz")
    seconds = lambda c: F.unix_micros(c.cast("timestamp")) / 1e6
    hours = (seconds(F.least(F.col("_end"), day + F.expr("INTERVAL 1 DAY"))) - seconds(F.greatest(F.col(start), day))) / 3600
    return e.withColumn("hours", F.greatest(F.lit(0.0), hours)).drop("_end")


def exact_lookup(df: DataFrame, table: DataFrame, on: Sequence[str], value: str, missing: str = "error") -> DataFrame:
    """Exact-key lookup, never interpolated. missing: error, null or drop."""
    if missing == "drop":
        return df.join(table.select(*on, value), list(on))
    found = df.join(table.select(*on, value), list(on), "left")
    if missing == "error":
        found = found.withColumn(value, F.when(F.col(value).isNull(), F.raise_error(F.lit(f"no {value} for a key")).cast("double")).otherwise(F.col(value)))
    return found


def missing_keys(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    return a.select(*on).distinct().join(b.select(*on), list(on), "left_anti")


def fresh_wins(history: DataFrame, fresh: DataFrame, on: Sequence[str]) -> DataFrame:
    """All fresh rows and the historical rows whose key has none."""
    return history.join(fresh.select(*on).distinct(), list(on), "left_anti").unionByName(fresh, allowMissingColumns=True)


def drop_overlap_join(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which ``b``'s columns win over equal names of ``a``."""
    return a.drop(*[c for c in a.columns if c in b.columns and c not in on]).join(b, list(on), "left")


def calendar_lag(df: DataFrame, by: Sequence[str], week: str, value: str, weeks: int) -> DataFrame:
    """The value exactly ``weeks`` weeks earlier by date; null when that week is absent."""
    past = df.select(*by, F.date_add(F.col(week), 7 * weeks).alias(week), F.col(value).alias(f"{value}_lag{weeks}"))
    return df.join(past, [*by, week], "left")


def pair_valves(forms: DataFrame, by: Sequence[str], order: str) -> tuple[DataFrame, DataFrame]:
    """Open forms get running numbers; the first close form after the opening that names a number ends it.

    Returns events and rejected close forms (number unknown at that time, or closed already). ``forms`` has kind (open
    or close), event_no (of close forms) and ``order``, the order of arrival within the keys.
    """
    opens = ranges.numbered(forms.where("kind = 'open'").drop("event_no"), by, order, "event_no").withColumnRenamed(order, "opened")
    closes = forms.where("kind = 'close'").withColumnRenamed(order, "closed")
    known = closes.alias("c").join(opens.select(*by, "event_no", "opened"), [*by, "event_no"]).where("opened < closed")
    first = known.groupBy(*by, "event_no").agg(F.min("closed").alias("closed"))
    events = opens.join(first, [*by, "event_no"], "left")
    rejected = closes.join(first, [*by, "event_no", "closed"], "left_anti")
    return events, rejected


def pixel_join(points: DataFrame, pixels: DataFrame, x0: float, y0: float, res: float) -> DataFrame:
    """Band values of the pixel that holds each point."""
    p = points.withColumns({"px": F.floor((F.col("x") - x0) / res), "py": F.floor((F.col("y") - y0) / res)})
    return p.join(pixels, ["px", "py"])


def points_in_polygons(points: DataFrame, polygons: DataFrame, x: str = "x", y: str = "y", cell: float = 50.0) -> DataFrame:
    """Points with the polygons they are in: even-odd crossings over the ring's edges, as expressions.

    A polygon is dealt to the cells of its bounding box and joined on the cell, so no point meets a far polygon.
    """
    box = lambda f, k: f(F.transform("ring", lambda p: p[k]))
    cells = lambda lo, hi: F.sequence(F.floor(lo / cell), F.floor(hi / cell))
    dealt = polygons.withColumn("_cx", F.explode(cells(box(F.array_min, "x"), box(F.array_max, "x")))).withColumn("_cy", F.explode(cells(box(F.array_min, "y"), box(F.array_max, "y"))))
    at = points.withColumns({"_cx": F.floor(F.col(x) / cell), "_cy": F.floor(F.col(y) / cell)})
    n = F.size("ring")

    def crossing(acc: Column, i: Column) -> Column:
        a, b = F.get(F.col("ring"), i), F.get(F.col("ring"), (i + 1) % n)
        straddles = (a["y"] > F.col(y)) != (b["y"] > F.col(y))
        where = (b["x"] - a["x"]) * (F.col(y) - a["y"]) / (b["y"] - a["y"]) + a["x"]
        return acc + F.when(straddles & (F.col(x) < where), 1).otherwise(0)

    crossings = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), crossing)
    return at.join(dealt, ["_cx", "_cy"]).where(crossings % 2 == 1).drop("_cx", "_cy", "ring")
