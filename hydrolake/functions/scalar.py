"""Column expressions of water and crop hydrology. All take and return Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Monthly pan evaporation norms (mm), January to December.
EVAPORATION_NORMS = (103.0692307692308, 115.03999999999999, 136.92461538461538, 152.96692307692308, 146.68923076923076, 140.09307692307695, 120.02538461538461, 125.63923076923078, 120.25076923076925, 112.23615384615384, 101.06923076923077, 99.02)
#: The weir.
CREST, WEIR_C, WEIR_LENGTH, GAUGE_OFFSET = 489.545, 1.82, 30.0, 0.155
SEASON_SCHEMES = ("three", "dry_to_40", "two")


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def iso_year(d) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _col(d)).cast("int")


def iso_week(d) -> Column:
    return F.weekofyear(_col(d))


def weekday(d) -> Column:
    """1 Monday to 7 Sunday."""
    return F.weekday(_col(d)) + 1


def monday(d) -> Column:
    return F.date_trunc("week", _col(d)).cast("date")


def week_start(year, week) -> Column:
    """Monday of an ISO week."""
    fourth = F.make_date(_col(year), F.lit(1), F.lit(4))
    return F.date_add(monday(fourth), 7 * (_col(week) - 1))


def season(week, scheme: str = "three") -> Column:
    w = _col(week)
    if scheme == "three":
        return F.when(w.between(10, 18), "summer").when(w.between(19, 44), "rainy").otherwise("winter")
    if scheme == "dry_to_40":
        return F.when(w.between(10, 18), "summer").when(w.between(22, 40), "rainy").otherwise("other")
    if scheme == "two":
        return F.when(w.between(18, 44), "wet").otherwise("dry")
    raise ValueError(f"unknown scheme {scheme}")


def season_code(week) -> Column:
    w = _col(week)
    return F.when(w.between(10, 18), 1).when(w.between(19, 44), 2).otherwise(0)


def cyclic(value, period: float) -> tuple[Column, Column]:
    angle = 2 * F.pi() * _col(value) / period
    return F.sin(angle), F.cos(angle)


def effective_rain(p, kind) -> Column:
    """Upland: 0.85 of what exceeds 5 mm; paddy: 0.8 of all. Another kind is an error."""
    p, kind = _col(p), _col(kind)
    unknown = F.raise_error(F.concat(F.lit("unknown kind of field: "), F.coalesce(kind, F.lit("null"))))
    return F.when(kind == "upland", F.greatest(F.lit(0.0), p - 5) * 0.85).when(kind == "paddy", p * 0.8).otherwise(unknown.cast("double"))


def saturation_pressure(celsius: Column) -> Column:
    return 0.6108 * F.exp(17.27 * celsius / (celsius + 237.3))


def humidity_and_deficit(t2m, d2m) -> tuple[Column, Column]:
    """Relative humidity (at most 100 %) and vapour pressure deficit (at least 0 kPa) from kelvins."""
    es, ea = saturation_pressure(_col(t2m) - 273.15), saturation_pressure(_col(d2m) - 273.15)
    return F.least(F.lit(100.0), 100 * ea / es), F.greatest(F.lit(0.0), es - ea)


def et0_penman_monteith(t2m, d2m, u10, v10, ssr, str_, elevation: float = 300.0) -> Column:
    """FAO-56 daily reference evapotranspiration (mm) from reanalysis means (kelvins, m/s, J/m2)."""
    t = _col(t2m) - 273.15
    es, ea = saturation_pressure(t), saturation_pressure(_col(d2m) - 273.15)
    slope = 4098 * es / F.pow(t + 237.3, F.lit(2.0))
    pressure = 101.3 * ((293 - 0.0065 * elevation) / 293) ** 5.26
    gamma = F.lit(0.000665 * pressure)
    wind = F.sqrt(_col(u10) * _col(u10) + _col(v10) * _col(v10)) * 4.87 / F.log(F.lit(67.8 * 10 - 5.42))
    radiation = (1 - 0.23) * _col(ssr) / 1e6 + _col(str_) / 1e6  # str is downward net: losses are negative
    top = 0.408 * slope * radiation + gamma * 900 / (t + 273) * wind * (es - ea)
    return top / (slope + gamma * (1 + 0.34 * wind))


def weir_flow(level, crest: float = CREST, c: float = WEIR_C, length: float = WEIR_LENGTH, offset: float = GAUGE_OFFSET) -> Column:
    """Cubic metres per second over the crest."""
    return c * length * F.pow(F.greatest(F.lit(0.0), _col(level) - offset - crest), F.lit(1.5))


def evaporation_mm(day, pan: float = 0.7, days_mode: str = "real") -> Column:
    """Daily evaporation from the month's norm; days_mode leap2000 counts February as 29 days always."""
    d = _col(day)
    norms = F.array(*map(F.lit, EVAPORATION_NORMS))
    days = F.day(F.last_day(d)) if days_mode == "real" else F.when(F.month(d) == 2, 29).otherwise(F.day(F.last_day(d)))
    return F.element_at(norms, F.month(d)) / days * pan


def aridity(et0, p, mode: str = "training") -> Column:
    et0, p = _col(et0), _col(p)
    if mode == "training":
        return F.round(F.least(et0 / (p + 0.001), F.lit(10.0)), 3)
    return F.when((p != 0), et0 / p)


def aridity_reasons(et0, p) -> Column:
    """Why the live index is missing."""
    et0, p = _col(et0), _col(p)
    return F.array_compact(F.array(F.when(et0.isNull(), "et0_missing"), F.when(p.isNull(), "rain_missing"), F.when(p == 0, "rain_zero")))


def normalised_difference(a, b) -> Column:
    a, b = _col(a), _col(b)
    return (a - b) / F.nullif(a + b, F.lit(0.0))


def soil_adjusted(nir, red) -> Column:
    n, r = _col(nir), _col(red)
    return 1.5 * (n - r) / F.nullif(n + r + 0.5, F.lit(0.0))


def decibel_ratio(vv, vh) -> tuple[Column, Column]:
    """VH - VV in dB and the linear ratio."""
    vv, vh = _col(vv), _col(vh)
    return vh - vv, F.pow(F.lit(10.0), vh / 10) / F.pow(F.lit(10.0), vv / 10)


def buddhist_year(y) -> Column:
    y = _col(y)
    return F.when(y > 2500, y - 543).otherwise(y)


def buddhist_date(text) -> Column:
    """8-digit text; years over 2500 are 543 ahead; malformed or impossible: null."""
    s = F.trim(_col(text))
    year = buddhist_year(F.substring(s, 1, 4).cast("int"))
    said = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.substring(s, 5, 2), F.substring(s, 7, 2))
    return F.when(s.rlike("^[0-9]{8}$"), F.to_date(F.try_to_timestamp(said, F.lit("yyyy-MM-dd"))))


def gap_flag(hours, limit: float = 1.0) -> Column:
    return _col(hours) > limit


def clamp_week(week) -> Column:
    return F.least(_col(week), F.lit(52))


def partial_week(day) -> Column:
    return F.weekday(_col(day)) != 6


def lag_risk(x, lag4, lag8) -> Column:
    """All three present and equal: the index may be a repeat."""
    x, a, b = _col(x), _col(lag4), _col(lag8)
    return F.coalesce((x == a) & (x == b), F.lit(False))


def staleness(as_of, run, warn: int = 3, block: int = 14) -> Column:
    gap = F.datediff(_col(run), _col(as_of))
    return F.when(gap <= warn, "ok").when(gap <= block, "warning").otherwise("blocked")


def flag_text(text) -> Column:
    """Booleans written as text."""
    return F.lower(F.trim(_col(text))).isin("true", "1")


def impute(value, sentinel: float, middle) -> Column:
    """Sentinel counts as missing; then the column's median; then 0."""
    return F.coalesce(F.nullif(_col(value), F.lit(sentinel)), _col(middle), F.lit(0.0))


#: FAO-56 at 300 m, as et0_penman_monteith.
_GAMMA = 0.000665 * (101.3 * ((293 - 0.0065 * 300.0) / 293) ** 5.26)
_ES, _EA = (f"(0.6108D * exp(17.27D * ({t} - 273.15D) / ({t} - 273.15D + 237.3D)))" for t in ("t2m", "d2m"))
_SLOPE = f"(4098D * {_ES} / pow(t2m - 273.15D + 237.3D, 2D))"
_WIND = "(sqrt(u10 * u10 + v10 * v10) * 4.87D / ln(67.8D * 10D - 5.42D))"
_ET0_SQL = f"(0.408D * {_SLOPE} * (0.77D * ssr / 1e6D + str / 1e6D) + {_GAMMA}D * 900D / (t2m - 273.15D + 273D) * {_WIND} * ({_ES} - {_EA})) / ({_SLOPE} + {_GAMMA}D * (1D + 0.34D * {_WIND}))"
#: A fold over a keeps the row of least costs; a fold over b builds the next one.
_DTW_SQL = """element_at(aggregate(sequence(0, size(a) - 1), concat(array(0D), array_repeat(double('infinity'), size(b))),
    (least_costs, i) -> aggregate(sequence(1, size(b)), array(double('infinity')),
        (acc, j) -> array_append(acc, abs(a[i] - b[j - 1]) + least(least_costs[j], least_costs[j - 1], acc[j - 1])))), size(b) + 1)"""


def register_all(spark) -> list[str]:
    """SQL functions of the scalar expressions, as SQL expressions (no Python at run time)."""
    bodies = {
        "hl_iso_year(d DATE) RETURNS INT": "CAST(extract(YEAROFWEEK FROM d) AS INT)",
        "hl_iso_week(d DATE) RETURNS INT": "weekofyear(d)",
        "hl_season(w INT) RETURNS STRING": "CASE WHEN w BETWEEN 10 AND 18 THEN 'summer' WHEN w BETWEEN 19 AND 44 THEN 'rainy' ELSE 'winter' END",
        "hl_sine(x DOUBLE, period DOUBLE) RETURNS DOUBLE": "sin(2D * pi() * x / period)",
        "hl_cosine(x DOUBLE, period DOUBLE) RETURNS DOUBLE": "cos(2D * pi() * x / period)",
        "hl_saturation_pressure(celsius DOUBLE) RETURNS DOUBLE": "0.6108D * exp(17.27D * celsius / (celsius + 237.3D))",
        "hl_et0(t2m DOUBLE, d2m DOUBLE, u10 DOUBLE, v10 DOUBLE, ssr DOUBLE, str DOUBLE) RETURNS DOUBLE": _ET0_SQL,
        "hl_db_ratio(vv DOUBLE, vh DOUBLE) RETURNS DOUBLE": "vh - vv",
        "hl_linear_ratio(vv DOUBLE, vh DOUBLE) RETURNS DOUBLE": "pow(10D, vh / 10D) / pow(10D, vv / 10D)",
        "hl_buddhist_date(said STRING) RETURNS DATE": """CASE WHEN trim(said) RLIKE '^[0-9]{8}$' THEN to_date(try_to_timestamp(concat_ws('-',
            lpad(CAST(CASE WHEN CAST(substring(trim(said), 1, 4) AS INT) > 2500 THEN CAST(substring(trim(said), 1, 4) AS INT) - 543 ELSE CAST(substring(trim(said), 1, 4) AS INT) END AS STRING), 4, '0'),
            substring(trim(said), 5, 2), substring(trim(said), 7, 2)), 'yyyy-MM-dd')) END""",
        "hl_dtw(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE": _DTW_SQL,
        "hl_week_start(y INT, w INT) RETURNS DATE": "date_add(CAST(date_trunc('week', make_date(y, 1, 4)) AS DATE), 7 * (w - 1))",
        "hl_season_code(w INT) RETURNS INT": "CASE WHEN w BETWEEN 10 AND 18 THEN 1 WHEN w BETWEEN 19 AND 44 THEN 2 ELSE 0 END",
        "hl_upland_rain(p DOUBLE) RETURNS DOUBLE": "greatest(0D, p - 5) * 0.85D",
        "hl_paddy_rain(p DOUBLE) RETURNS DOUBLE": "p * 0.8D",
        "hl_weir_flow(level DOUBLE) RETURNS DOUBLE": f"{WEIR_C}D * {WEIR_LENGTH}D * pow(greatest(0D, level - {GAUGE_OFFSET}D - {CREST}D), 1.5D)",
        "hl_aridity(et0 DOUBLE, p DOUBLE) RETURNS DOUBLE": "round(least(et0 / (p + 0.001D), 10D), 3)",
        "hl_savi(nir DOUBLE, red DOUBLE) RETURNS DOUBLE": "1.5D * (nir - red) / nullif(nir + red + 0.5D, 0D)",
        "hl_ndi(a DOUBLE, b DOUBLE) RETURNS DOUBLE": "(a - b) / nullif(a + b, 0D)",
        "hl_buddhist_year(y INT) RETURNS INT": "CASE WHEN y > 2500 THEN y - 543 ELSE y END",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.partition("(")[0] for h in bodies]
