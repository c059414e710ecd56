"""Stand-in water data: deterministic views of the given tables, once for Spark and once as DuckDB SQL.

Expressions that both dialects read alike are written once; a pair (spark, duckdb) is used where they differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Expr = str | tuple[str, str]


@dataclass(frozen=True)
class View:
    source: str  # a table, another view, or range(n)
    columns: dict[str, Expr]
    where: Expr | None = None
    group_by: tuple[str, ...] = ()
    aggregates: tuple[str, ...] = ()  # columns that aren't functions of the group's keys


def _of(e: Expr, i: int) -> str:
    return e if isinstance(e, str) else e[i]


DAY = ("CAST(l_shipdate AS DATE)", "CAST(l_shipdate AS DATE)")
_CENTS = "sum(CAST(round(o_totalprice * 100) AS BIGINT)) / (count(*) * 1e2)"  # exact sums: no order of adding

VIEWS: dict[str, View] = {
    "telemetry_long": View(
        "events",
        {
            "station": "concat('RES00', CAST(user_id % 4 AS STRING))",
            "data_type": "CASE event_type WHEN 'view' THEN 'water_level' WHEN 'click' THEN 'rainfall_1h' WHEN 'signup' THEN 'temperature' WHEN 'purchase' THEN 'humidity' ELSE 'solar' END",
            "ts": "ts",
            "value": "CASE WHEN event_type = 'view' THEN 485 + value * 1.00000314159265e-2 ELSE value * 1.4142135623730951e0 END",
            "row_id": "event_id",
        },
    ),
    "arrivals": View(
        "events",
        {
            "station": "concat('RES00', CAST(user_id % 4 AS STRING))",
            "fetch_time": "ts",
            "measure_datetime": "CASE WHEN event_id % 17 = 0 THEN ts - INTERVAL 2 HOUR ELSE ts END",
            "water_level": "485 + value * 1.00000314159265e-2",
            "row_id": "event_id",
        },
        "event_type = 'view'",
    ),
    "rating_curve": View(  # the centimetres of level that a station has seen; area and storage rise with them
        "events",
        {
            "station": "concat('RES00', CAST(user_id % 4 AS STRING))",
            "level": "(48500 + CAST(floor(value) AS BIGINT)) / 1e2",
            "z_factor": "1e0",
            "area_m2": "1e5 + 3e2 * (220 + max(CAST(floor(value) AS BIGINT)))",
            "storage_m3": "5e5 + 1e3 * (220 + max(CAST(floor(value) AS BIGINT))) + 1.5e0 * (220 + max(CAST(floor(value) AS BIGINT))) * (220 + max(CAST(floor(value) AS BIGINT)))",
        },
        "event_type = 'view'",
        group_by=("concat('RES00', CAST(user_id % 4 AS STRING))", "(48500 + CAST(floor(value) AS BIGINT)) / 1e2"),
        aggregates=("z_factor", "area_m2", "storage_m3"),
    ),
    "valve_rates": View(
        "range(22)",
        {"outlet_side": "CASE WHEN id % 2 = 0 THEN 'inlet' ELSE 'spillway' END", "turns": "1 + CAST(floor(id / 2e0) AS BIGINT)", "q_m3h": "6.9e0 * (1 + CAST(floor(id / 2e0) AS BIGINT)) + 1e1 * (id % 2)"},
    ),
    "release_events": View(
        "events",
        {
            "event_no": "event_id",
            "station": "concat('RES00', CAST(user_id % 4 AS STRING))",
            "start_ts": "ts",
            "end_ts": ("CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts + make_dt_interval(CAST(event_id % 10 AS INT)) END", "CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts + to_days(CAST(event_id % 10 AS INTEGER)) END"),
            "rate_m3_per_day": "value * 20",
            "turns": "1 + event_id % 11",
            "outlet_side": "CASE WHEN event_id % 2 = 0 THEN 'inlet' ELSE 'spillway' END",
        },
        "event_type = 'purchase'",
    ),
    "rain_daily": View(
        "lineitem",
        {
            "zone": "CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'B' END",
            "date": "CAST(l_shipdate AS DATE)",
            "precipitation": "greatest(0e0, (sum(l_quantity) / count(*) - 22) * 1.4142135623730951e0)",
            "data_type": ("CASE WHEN unix_date(CAST(l_shipdate AS DATE)) % 10 < 7 THEN 'final' WHEN unix_date(CAST(l_shipdate AS DATE)) % 10 < 9 THEN 'prelim_ftp' ELSE 'prelim' END",
                          "CASE WHEN (CAST(l_shipdate AS DATE) - DATE '1970-01-01') % 10 < 7 THEN 'final' WHEN (CAST(l_shipdate AS DATE) - DATE '1970-01-01') % 10 < 9 THEN 'prelim_ftp' ELSE 'prelim' END"),
        },
        group_by=("CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'B' END", "CAST(l_shipdate AS DATE)"),
        aggregates=("precipitation",),
    ),
    "rain_holes": View(  # for the operators that list and fill missing weeks: every 13th week is missing
        "rain_daily",
        {"zone": "zone", "date": "date", "precipitation": "precipitation", "data_type": "data_type"},
        ("floor((unix_date(date) + 3) / 7) % 13 <> 5", "((date - DATE '1970-01-01') + 3) // 7 % 13 <> 5"),
    ),
    "weather_daily": View(
        "orders",
        {
            "zone": "CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END",
            "date": "CAST(o_orderdate AS DATE)",
            "t2m": f"290 + {_CENTS} / 4e4",
            "d2m": f"286 + {_CENTS} / 5e4 - count(*) % 3",
            "u10": "1e0 + count(*) % 4 * 5e-1",
            "v10": "count(*) % 3 - 1e0",
            "ssr": f"8e6 + {_CENTS} * 3e1",
            "str": f"-3e6 - {_CENTS} * 4e0",
        },
        group_by=("CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END", "CAST(o_orderdate AS DATE)"),
        aggregates=("t2m", "d2m", "u10", "v10", "ssr", "str"),
    ),
    "monthly_index": View(
        "orders",
        {"year": "CAST(year(o_orderdate) AS INT)", "month": "CAST(month(o_orderdate) AS INT)", "mei": "CASE WHEN count(*) % 11 = 5 THEN NULL ELSE ((count(*) * 37) % 50 - 25) / 1e1 END"},
        group_by=("CAST(year(o_orderdate) AS INT)", "CAST(month(o_orderdate) AS INT)"),
        aggregates=("mei",),
    ),
    "parcels": View(
        "orders",
        {
            "parcel_id": "o_orderkey",
            "plant_text": ("concat(CAST(year(o_orderdate) + 543 AS STRING), date_format(o_orderdate, 'MMdd'))", "concat(CAST(year(o_orderdate) + 543 AS VARCHAR), strftime(o_orderdate, '%m%d'))"),
            "harvest_text": ("date_format(date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 400 AS INT)), 'yyyyMMdd')", "strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER), '%Y%m%d')"),
            "crop": "CASE o_orderpriority WHEN '1-URGENT' THEN 'rice' WHEN '2-HIGH' THEN 'corn' WHEN '3-MEDIUM' THEN 'cassava' WHEN '4-NOT SPECIFIED' THEN 'longan' ELSE 'shrub' END",
            "area_rai": "sqrt(o_totalprice) / 1e2",
            "lat": "18 + (o_custkey % 100) / 1e2",
            "lon": "99 + (o_orderkey % 100) / 1e2",
        },
    ),
    "pixels": View(
        "lineitem",
        {
            "px": "l_partkey % 200", "py": "l_suppkey % 200", "class_id": "l_partkey % 5",
            "zone": "CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'B' END",
            "day": "CAST(l_shipdate AS DATE)", "scene": "l_orderkey", "cloud": "l_linenumber * 3",
            "green": "l_quantity * 2.00003141592e-2", "red": "l_discount + 1.00003141592e-1", "rededge": "l_discount + 3.00003141592e-1", "nir": "3e-1 + l_tax * 3",
            "vv": "CASE WHEN l_linenumber = 7 THEN -9999e0 ELSE -8 - l_quantity * 1.00003141592e-1 END",
            "vh": "CASE WHEN l_linenumber = 7 THEN -9999e0 ELSE -14 - l_quantity * 1.00003141592e-1 - l_discount * 10 END",
        },
    ),
    "predictions": View(
        "orders",
        {
            "row_id": "o_orderkey",
            "zone": "CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END",
            "date": "CAST(o_orderdate AS DATE)",
            "year": "CAST(year(o_orderdate) AS INT)",
            "horizon": "CAST(1 + o_orderkey % 12 AS INT)",
            "split": "CASE WHEN year(o_orderdate) < 1998 THEN 'train' WHEN year(o_orderdate) < 2000 THEN 'calib' ELSE 'test' END",
            "y": "CASE WHEN o_orderkey % 3 = 0 THEN 0e0 ELSE sqrt(o_totalprice) * 4e2 END",
            "prob": "CASE WHEN o_orderkey % 3 = 0 THEN ((o_orderkey * 7919) % 600) / 1e3 ELSE (400 + (o_orderkey * 7919) % 600) / 1e3 END",
            "m1": "sqrt(o_totalprice) * 4e2 * (8e-1 + (o_orderkey % 5) / 1e1)",
            "m2": "sqrt(o_totalprice) * 4e2 * (7e-1 + (o_orderkey % 7) / 1e1)",
            "klass": "CAST(o_custkey % 4 AS INT)",
            "klass_hat": "CAST(CASE WHEN o_orderkey % 5 = 0 THEN (o_custkey + 1) % 4 ELSE o_custkey % 4 END AS INT)",
        },
    ),
    "crop_area": View(
        "range(14)",
        {"zone": "CASE WHEN id % 2 = 0 THEN 'A' ELSE 'B' END", "crop": "CASE CAST(floor(id / 2e0) AS INT) WHEN 0 THEN 'rice' WHEN 1 THEN 'corn' WHEN 2 THEN 'cassava' WHEN 3 THEN 'longan' WHEN 4 THEN 'rubber' WHEN 5 THEN 'etc' ELSE 'durian' END", "area_m2": "1e5 * (1 + id)"},
    ),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    v = VIEWS[name]
    if v.source.startswith("range"):
        df = spark.range(int(v.source[6:-1]))
    elif v.source in VIEWS:
        df = view(spark, sf_dir, v.source)
    else:
        df = spark.read.parquet(f"{sf_dir}/{v.source}.parquet")
    if v.where:
        df = df.where(_of(v.where, 0))
    columns = [f"{_of(e, 0)} AS `{c}`" for c, e in v.columns.items()]
    if not v.group_by:
        return df.selectExpr(*columns)
    from pyspark.sql import functions as F

    keys = list(v.columns)[: len(v.group_by)]
    rest = [c for c in v.columns if c not in keys]
    grouped = df.groupBy(*[F.expr(g).alias(k) for g, k in zip(v.group_by, keys, strict=True)])
    out = grouped.agg(*[F.expr(_of(v.columns[c], 0)).alias(c) for c in v.aggregates])
    # what depends on the keys alone follows them
    from_keys = {c: _of(v.columns[c], 0) for c in rest if c not in v.aggregates}
    for c, e in from_keys.items():
        for g, k in zip(v.group_by, keys, strict=True):
            e = e.replace(g, k)
        out = out.withColumn(c, F.expr(e))
    return out.select(*v.columns)


def sql(*names: str) -> str:
    """The views as a WITH clause's parts, for DuckDB."""
    parts = []
    for name in names:
        v = VIEWS[name]
        source = f"(SELECT range AS id FROM {v.source})" if v.source.startswith("range") else v.source
        text = f"SELECT {', '.join(f'{_of(e, 1)} AS "{c}"' for c, e in v.columns.items())} FROM {source}"
        if v.where:
            text += f" WHERE {_of(v.where, 1)}"
        if v.group_by:
            text += " GROUP BY ALL"
        parts.append(f"{name} AS ({text})")
    return ", ".join(parts)
