"""Sources and sinks: wide logs, nested messages, curves, index texts, idempotent and append writes, documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATA_TYPES = ("water_level", "rainfall_1h", "temperature", "humidity", "pressure", "solar")
LENIENT = "yyyy-M-d H:m:s"
MESSAGE = "struct<remark:string,project_name:string,data:array<struct<station_code:string,station_name:string,measure_datetime:string,data_type:string,data:string>>>"


def read_wide_log(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV of text columns; rows without measure_datetime are left out; the time needn't be zero-padded."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return wide_log(spark.read.csv(path, header=True, schema=schema))


def wide_log(raw: DataFrame) -> DataFrame:
    rows = raw.where(F.trim("measure_datetime") != "")
    return rows.withColumn("measure_datetime", F.try_to_timestamp(F.trim("measure_datetime"), F.lit(LENIENT)).cast("timestamp_ntz"))


def wide_to_long(wide: DataFrame, ids: Sequence[str] = ("measure_datetime",)) -> DataFrame:
    """<station>_<type> columns to rows; empty text is missing and gives no row."""
    values = [c for c in wide.columns if c not in ids]
    long = wide.unpivot(list(ids), values, "metric", "text")
    kinds = "|".join(DATA_TYPES)
    return long.where(F.trim("text") != "").select(
        *ids, F.regexp_extract("metric", f"^(.*)_({kinds})$", 1).alias("station"), F.regexp_extract("metric", f"^(.*)_({kinds})$", 2).alias("data_type"),
        F.expr("try_cast(trim(text) AS DOUBLE)").alias("value"),
    )


def parse_telemetry_json(raw: DataFrame, col: str, stations: Sequence[str], types: Sequence[str] = DATA_TYPES, ids: Sequence[str] = ()) -> DataFrame:
    """One row per message and wanted station: a value per known type (the last one said), missing types, found flag, the
    first measure_datetime and whether several times are mixed."""
    read = raw.withColumn("_m", F.from_json(col, MESSAGE)).withColumn("station", F.explode(F.array(*map(F.lit, stations))))
    own = F.filter(F.coalesce("_m.data", F.array().cast("array<struct<station_code:string,station_name:string,measure_datetime:string,data_type:string,data:string>>")), lambda d: d["station_code"] == F.col("station"))
    out = read.withColumn("_own", own)
    last = lambda t: F.expr("try_cast(element_at(filter(_own, d -> d.data_type = '%s'), -1).data AS DOUBLE)" % t)
    seen = F.array_distinct(F.transform("_own", lambda d: d["data_type"]))
    times = F.array_distinct(F.transform("_own", lambda d: d["measure_datetime"]))
    return out.select(
        *ids, "station", *[F.when(F.size(F.filter("_own", lambda d: d["data_type"] == t)) > 0, last(t)).alias(t) for t in types],
        F.array_join(F.array_sort(F.array_except(F.array(*map(F.lit, types)), seen)), ",").alias("missing_types"),
        (F.size("_own") > 0).alias("found"), F.get(F.col("_own"), F.lit(0))["measure_datetime"].alias("measure_datetime"), (F.size(times) > 1).alias("mixed_times"),
    )


def read_curve(spark: SparkSession, path: str, by: str | None = None) -> DataFrame:
    """Level, area and storage; with ``by``, of all curves in a folder that is partitioned by that column."""
    schema = "msl_height DOUBLE, z_factor DOUBLE, surface_area_m2 DOUBLE, storage_m3 DOUBLE" + (f", {by} STRING" if by else "")
    return spark.read.csv(path, header=True, schema=schema).where("msl_height IS NOT NULL")


def parse_bimonthly_index(lines: DataFrame, col: str = "value") -> DataFrame:
    """Rows of 13 tokens that begin with a year: one row per month; -999 and what isn't a number are null."""
    tokens = F.split(F.trim(col), r"\s+")
    good = lines.withColumn("_t", tokens).where((F.size("_t") == 13) & F.expr("try_cast(_t[0] AS INT)").isNotNull())
    long = good.select(F.expr("CAST(_t[0] AS INT)").alias("year"), F.posexplode(F.slice("_t", 2, 12)).alias("_i", "_v"))
    return long.select("year", (F.col("_i") + 1).alias("month"), F.expr("nullif(try_cast(_v AS DOUBLE), -999D)").alias("mei"))


def parse_season_index(lines: DataFrame, order: str, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Rows of 4 tokens (season year total anomaly), bad rows skipped; and the latest: the last row by ``order``."""
    good = lines.withColumn("_t", F.split(F.trim(col), r"\s+")).where(F.size("_t") == 4)
    rows = good.select(order, F.expr("_t[0]").alias("season"), F.expr("try_cast(_t[1] AS INT)").alias("year"), F.expr("try_cast(_t[2] AS DOUBLE)").alias("total"), F.expr("try_cast(_t[3] AS DOUBLE)").alias("anomaly"))
    rows = rows.where("year IS NOT NULL AND total IS NOT NULL AND anomaly IS NOT NULL")
    latest = rows.agg(F.max_by(F.struct(*rows.columns), order).alias("x")).where("x IS NOT NULL").select("x.*")
    return rows, latest


def read_release_events(raw: DataFrame) -> DataFrame:
    """Start and end from date and time texts; the end is open if either of its fields is blank."""
    ts = lambda d, t: F.try_to_timestamp(F.concat_ws(" ", F.trim(d), F.concat(F.trim(t), F.lit(":0"))), F.lit(LENIENT)).cast("timestamp_ntz")
    blank = (F.coalesce(F.trim("end_date"), F.lit("")) == "") | (F.coalesce(F.trim("end_time"), F.lit("")) == "")
    return raw.withColumns({"start_ts": ts("start_date", "start_time"), "end_ts": F.when(~blank, ts("end_date", "end_time")), "rate_m3_per_day": F.expr("try_cast(rate_m3_per_day AS DOUBLE)")})


def read_monthly_daily_table(raw: DataFrame, order: str, by: Sequence[str] = ()) -> DataFrame:
    """(year, month, day text) to a date; impossible days are left out; of a date's rows the last counts."""
    day = F.expr("try_cast(trim(day) AS INT)")
    dated = raw.withColumn("date", F.expr("CAST(try_to_timestamp(concat_ws('-', year, month, try_cast(trim(day) AS INT)), 'y-M-d') AS DATE)")).where(day.isNotNull() & F.col("date").isNotNull())
    return dated.groupBy(*by, "date").agg(F.max_by(F.struct(*[c for c in raw.columns if c not in by]), order).alias("x")).select(*by, "date", "x.*")


def read_year_week_history(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=False).select(*columns).dropDuplicates(["year", "week"])


def write_idempotent(df: DataFrame, path: str, key: str) -> None:
    """Replace the rows of the keys in ``df`` and keep others: a partition per key, overwritten one by one."""
    df.sortWithinPartitions(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def upserted(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """What write_idempotent leaves, as a table."""
    return old.join(new.select(*key).distinct(), list(key), "left_anti").unionByName(new)


def append_run_log(df: DataFrame, path: str, columns: Sequence[str], by: str = "zone") -> None:
    df.select(*columns).write.mode("append").partitionBy(by).parquet(path)


def write_document(df: DataFrame, path: str) -> None:
    """Nested rows as JSON lines; the committer's rename makes it appear whole."""
    df.write.mode("overwrite").json(path)


def align_schema(lines: DataFrame, old: Sequence[str], new: Sequence[str], col: str = "value") -> DataFrame:
    """Comma-parted rows of two layouts: by the new header if the length fits it, else by the old one; missing: ''."""
    cells = F.split(col, ",", -1)
    width = F.size("_c")

    def cell(name: str) -> Column:
        def at(header: Sequence[str]) -> Column:
            return F.coalesce(F.get(F.col("_c"), F.lit(list(header).index(name))), F.lit("")) if name in header else F.lit("")

        return F.when(width == len(old), at(old)).when(width == len(new), at(new)).otherwise(at(old)).alias(name)

    return lines.withColumn("_c", cells).select(*[c for c in lines.columns if c != col], *[cell(n) for n in new])


def monitoring_document(snapshot: DataFrame, history: DataFrame, static: DataFrame, key: str = "station") -> DataFrame:
    """Static stations with their snapshot and a nested history (time, level), oldest first; stations without telemetry stay."""
    nested = history.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("t", "level"))).alias("history"))
    return static.join(snapshot, key, "left").join(nested, key, "left")


def forecast_document(preds: DataFrame, by: Sequence[str], status: str = "status") -> DataFrame:
    """A map horizon -> (value, low, high) per target."""
    entries = F.sort_array(F.collect_list(F.struct("horizon", F.struct("value", "low", "high"))))
    has = F.count("value") > 0
    return preds.groupBy(*by).agg(F.map_from_entries(entries).alias("horizons"), F.when(has, F.max(status)).otherwise("model_missing_pending_retrain").alias("status"))
