"""Streaming twins of the telemetry operators. Each takes a streaming DataFrame and returns one.

Windows are given out when the watermark has passed them (append mode) and leave the state then, so the state holds the
open windows only. A stream that ends has open windows, too: a clock, a second source whose rows have a time and
nothing else, moves the watermark past them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hydrolake.operators import series

END = "9999-01-01 00:00:00"
NEVER = -(1 << 62)  # before all times
WIDTH = 10_000  # arrival numbers that are put in order together
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_ingest(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A Parquet folder or file pattern as a stream; the schema is that of what is there."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") else reader.parquet(path)


def written(spark: SparkSession, folder: str, schema, inside: str = "") -> DataFrame:
    """The Parquet rows of a sink's folder (``inside``: a pattern of its own); none if no batch has written it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(schema).parquet(folder + inside) if there else spark.createDataFrame([], schema)


def clock_folder(spark: SparkSession, folder: str) -> str:
    """An empty clock in a new folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)
    return folder


def tick(spark: SparkSession, clock: str, at: str = END) -> None:
    """A clock row: what reads it knows that nothing before ``at`` (less its delay) comes any more."""
    spark.range(1).select(F.lit(at).cast("timestamp").alias("_t")).write.mode("append").parquet(clock)


def timed(rows: DataFrame, by: Sequence[str], ts: str, clock: str | None) -> DataFrame:
    """``rows`` with _t (the time) and _real (1), and the clock's rows, in which all but _t is null.

    Filters on keys would be pushed below the watermark and take the clock's rows with them, so that aggregates count
    _real and leave out groups without any. Keys of rows without a time, which no window holds, are null: so keys may
    be null in every batch's plan, whether it has clock rows or not, and the state's schema stays.
    """
    x = rows.withColumns({"_t": F.col(ts).cast("timestamp"), "_real": F.lit(1)})
    if clock is None:
        return x
    x = x.withColumns({c: F.when(F.col("_t").isNotNull(), F.col(c)) for c in by})
    return x.unionByName(rows.sparkSession.readStream.schema("_t timestamp").parquet(clock), allowMissingColumns=True)


def stream_hourly(rows: DataFrame, by: Sequence[str], ts: str, value: str, delay: str = "1 hour", clock: str | None = None) -> DataFrame:
    """Tumbling hours: last, mean and count. Empty hours are added when the table is read."""
    x = timed(rows, by, ts, clock).withWatermark("_t", delay)
    hours = x.groupBy(*by, F.window("_t", "1 hour")).agg(F.max_by(value, "_t").alias("last"), F.avg(value).alias("mean"), F.count("_real").alias("n"))
    return hours.where("n > 0").select(*by, F.col("window.start").alias("hour"), "last", "mean", "n")


def stream_latest(rows: DataFrame, by: Sequence[str], order: str, ts: str, value: str) -> DataFrame:
    """The last value per key and its place in arrival order, for update mode: a state row per key, and changed keys out."""
    known = rows.where(F.col(value).isNotNull())
    return known.groupBy(*by).agg(F.max_by(value, order).alias("value"), F.max_by(ts, order).alias("ts"), F.max(order).alias(order))


def stream_daily_rain(rows: DataFrame, by: Sequence[str], ts: str, rain: str, delay: str = "26 hours", clock: str | None = None) -> DataFrame:
    """Rain of the 24 hour marks of days that end at 07:00, each mark by its nearest reading within half an hour.

    Two aggregates in turn: a mark's nearest reading, which leaves the state as the mark closes, and the sum of a day's
    marks. A mark's group ends an hour after it, so days are cut at 08:00.
    """
    x = timed(rows, by, ts, clock)
    base = F.date_trunc("hour", "_t")
    x = x.withColumn("mark", F.explode(F.array(base, base + F.expr("INTERVAL 1 HOUR"))))
    x = x.withColumn("_d", F.abs(F.unix_micros("_t") - F.unix_micros("mark"))).where(F.col("_d") <= 1_800_000_000)
    nearest = F.min(F.when(F.col("_real") == 1, F.struct("_d", "_t", F.col(rain).alias("r"))))
    marks = x.withWatermark("mark", delay).groupBy(*by, F.window("mark", "1 hour")).agg(nearest.alias("best"))
    found = F.col("best").isNotNull()
    days = marks.groupBy(*by, F.window(F.window_time("window"), "24 hours", "24 hours", "8 hours").alias("day")).agg(
        F.sum(F.when(found, F.coalesce("best.r", F.lit(0.0)))).alias("rain_24h_mm"), F.count_if(found).alias("hours_covered")
    )
    return days.where("hours_covered > 0").select(*by, F.to_date("day.end").alias("date"), "rain_24h_mm", "hours_covered")


def stream_rolling_rain(daily: DataFrame, by: Sequence[str], delay: str = "7 days", clock: str | None = None) -> DataFrame:
    """Sliding 7-day rain, a window per day."""
    x = timed(daily, by, "date", clock).withWatermark("_t", delay)
    weeks = x.groupBy(*by, F.window("_t", "7 days", "1 day")).agg(F.sum("precipitation").alias("rain"), F.count("_real").alias("n_days"))
    return weeks.where("n_days > 0").select(*by, F.date_sub(F.to_date("window.end"), 1).alias("last_day"), "rain", "n_days")


def _in_order():
    """A function that gives a key's rows of one micro-batch in the order of column o, by bounded pieces.

    Rows come in any order, in as many frames as they fill. Those of a single frame are sorted; else they are laid down in
    the state by their number's range, and each range is read, sorted and given out by itself.
    """

    def pieces(frames: Iterator[pd.DataFrame], laid, columns: list[str], width: int) -> Iterator[pd.DataFrame]:
        first, second = next(frames, None), next(frames, None)
        if first is None:
            return
        if second is None:
            yield first.sort_values("o", kind="stable")
            return

        def lay(frame: pd.DataFrame) -> None:
            for part, own in frame.groupby(frame["o"] // width):
                known = laid.getValue((int(part),)) if laid.containsKey((int(part),)) else ([],) * len(columns)
                laid.updateValue((int(part),), tuple([*old, *own[c].tolist()] for old, c in zip(known, columns, strict=True)))

        lay(first)
        lay(second)
        for frame in frames:
            lay(frame)
        for part in sorted(k[0] for k in laid.keys()):
            own = laid.getValue((part,))
            laid.removeKey((part,))
            yield pd.DataFrame(dict(zip(columns, own, strict=True))).sort_values("o", kind="stable")

    return pieces


def stream_monotonic_gap(rows: DataFrame, key: str, order: str, ts: str, limit_h: float = 1.0, width: int = WIDTH) -> DataFrame:
    """Per key the last accepted time as state: a reading is stored iff it is later; gaps over the limit are flagged.

    Needs the RocksDB state store (``run_to_table`` and ``run_split`` with ``keyed=True`` set it).
    """
    pieces = _in_order()

    class Accept(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last", "t long")
            self.laid = handle.getMapState("laid", "part long", "o array<long>, t array<long>")

        def handleInputRows(self, keys, frames, timers) -> Iterator[pd.DataFrame]:
            last = self.last.get()[0] if self.last.exists() else None
            for piece in pieces(frames, self.laid, ["o", "t"], width):
                times = piece["t"].to_numpy()
                latest = np.maximum.accumulate(np.append([NEVER if last is None else last], times))
                before, last = latest[:-1], int(latest[-1])
                gap = np.where(before > NEVER, (times - before) / 3.6e9, np.nan)
                yield pd.DataFrame({"key": keys[0], "row_id": piece["o"].to_numpy(), "stored": times > before, "gap_hours": gap, "gap_flag": (times > before) & (gap > limit_h)})
            if last is not None:
                self.last.update((last,))

        def close(self) -> None:
            pass

    slim = rows.select(F.col(key).alias("key"), F.col(order).alias("o"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"))
    return slim.groupBy("key").transformWithStateInPandas(Accept(), "key string, row_id long, stored boolean, gap_hours double, gap_flag boolean", "Append", "None")


def stream_valve_pairing(forms: DataFrame, key: str, order: str, width: int = WIDTH) -> DataFrame:
    """Open events per key as a map state; a close form ends the open event it names or is rejected.

    Needs the RocksDB state store (``run_to_table`` with ``keyed=True`` sets it).
    """
    pieces = _in_order()

    class Pair(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.count = handle.getValueState("count", "n long")
            self.open = handle.getMapState("open", "event_no long", "opened long")
            self.laid = handle.getMapState("laid", "part long", "o array<long>, kind array<string>, no array<long>")

        def handleInputRows(self, keys, frames, timers) -> Iterator[pd.DataFrame]:
            count = self.count.get()[0] if self.count.exists() else 0
            for piece in pieces(frames, self.laid, ["o", "kind", "no"], width):
                out = []
                for o, kind, no in piece[["o", "kind", "no"]].itertuples(index=False):
                    if kind == "open":
                        count += 1
                        self.open.updateValue((count,), (int(o),))
                        out.append((keys[0], int(o), count, "opened"))
                    elif self.open.containsKey((int(no),)):
                        self.open.removeKey((int(no),))
                        out.append((keys[0], int(o), int(no), "closed"))
                    else:
                        out.append((keys[0], int(o), int(no), "rejected"))
                yield pd.DataFrame(out, columns=["key", "row_id", "event_no", "outcome"])
            self.count.update((count,))

        def close(self) -> None:
            pass

    slim = forms.select(F.col(key).alias("key"), F.col(order).alias("o"), "kind", F.coalesce("event_no", F.lit(-1).cast("long")).alias("no"))
    return slim.groupBy("key").transformWithStateInPandas(Pair(), "key string, row_id long, event_no long, outcome string", "Append", "None")


class UpsertTable:
    """A table in which rows replace those with their key, the newest by ``order`` wins; ``write`` is a foreachBatch sink.

    Keys are dealt to partitions by a hash. A batch rewrites the partitions that it touches, as a new version of each, and
    then logs the versions of all; readers take the last whole log, so that a batch is seen whole or not at all. A batch
    that is logged is left out when it comes again, and one that failed before that is written over, so replays change
    nothing. ``vacuum`` removes versions that no kept log names.
    """

    def __init__(self, path: str, key: Sequence[str], order: str, partitions: int = 16) -> None:
        self.path, self.key, self.order, self.partitions = path, list(key), order, partitions

    def _files(self, spark: SparkSession):
        at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path

    def logged(self, spark: SparkSession) -> list[int]:
        """The numbers of logged batches, oldest first; a log that wasn't finished has no mark of success."""
        fs, path = self._files(spark)
        if not fs.exists(path(f"{self.path}/log")):
            return []
        numbers = [int(f.getPath().getName()) for f in fs.listStatus(path(f"{self.path}/log")) if f.getPath().getName().isdigit()]
        return sorted(n for n in numbers if fs.exists(path(f"{self.path}/log/{n}/_SUCCESS")))

    def versions(self, spark: SparkSession, number: int | None = None) -> dict[int, int]:
        """Partition to the batch that wrote it last, as of a logged batch (default: the last); at most ``partitions`` rows."""
        known = self.logged(spark) if number is None else [number]
        rows = spark.read.schema("part int, batch long").json(f"{self.path}/log/{known[-1]}").collect() if known else []
        return {r["part"]: r["batch"] for r in rows}

    def write(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number <= max(self.logged(spark), default=-1):
            return
        versions = self.versions(spark)
        part = F.pmod(F.xxhash64(*self.key), F.lit(self.partitions)).cast("int")
        new = series.dedup_latest(batch, self.key, self.order).withColumn("_part", part).persist()
        try:
            touched = [r["_part"] for r in new.select("_part").distinct().collect()]  # at most ``partitions``
            if not touched:
                return
            old = [f"{self.path}/rows/{versions[p]}/_part={p}" for p in touched if p in versions]
            rows = new
            if old:
                before = spark.read.schema(batch.schema).parquet(*old).withColumn("_part", part)
                rows = series.dedup_latest(before.unionByName(new), self.key, self.order)
            rows.repartition("_part").write.partitionBy("_part").mode("overwrite").parquet(f"{self.path}/rows/{number}")
            log = spark.createDataFrame(sorted((versions | dict.fromkeys(touched, number)).items()), "part int, batch long")
            log.coalesce(1).write.mode("overwrite").json(f"{self.path}/log/{number}")
        finally:
            new.unpersist()

    def read(self, spark: SparkSession, schema) -> DataFrame:
        paths = [f"{self.path}/rows/{batch}/_part={part}" for part, batch in self.versions(spark).items()]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Remove what only readers of logs older than the last ``keep`` need."""
        fs, path = self._files(spark)
        known = self.logged(spark)
        kept = {v for n in known[-keep:] for v in self.versions(spark, n).items()}
        for n in known[:-keep]:
            for p, b in set(self.versions(spark, n).items()) - kept:
                fs.delete(path(f"{self.path}/rows/{b}/_part={p}"), True)
            fs.delete(path(f"{self.path}/log/{n}"), True)


@contextmanager
def state_store(spark: SparkSession, keyed: bool) -> Iterator[None]:
    """The state store that keyed states need, for queries started inside."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    if keyed:
        spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        if keyed:
            spark.conf.set(name, before) if before else spark.conf.unset(name)


def run_through(writer, spark: SparkSession, folder: str, keyed: bool = False, clock: str | None = None) -> list[dict]:
    """Run all that is there; with a clock, once more after its last tick. The progress of all batches."""
    seen = []
    for last in [False, True] if clock else [False]:
        if last:
            tick(spark, clock)
        with state_store(spark, keyed):
            q = writer.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        q.awaitTermination()
        seen += q.recentProgress
    return seen


def run_to_table(stream: DataFrame, folder: str, keyed: bool = False, clock: str | None = None) -> DataFrame:
    """Run all that is there and return what was written to a Parquet folder."""
    spark = stream.sparkSession
    run_through(stream.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out"), spark, folder, keyed, clock)
    return written(spark, f"{folder}/out", stream.schema)


def run_split(stream: DataFrame, folder: str, anomaly: str, keyed: bool = True) -> tuple[DataFrame, DataFrame]:
    """Run all that is there into two tables: rows that are no anomaly by the condition, and those that are.

    Each batch has a folder of its own in both, so that a repeated batch writes over itself.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        kept.where(f"NOT ({anomaly})").write.mode("overwrite").parquet(f"{folder}/history/batch={number}")
        kept.where(anomaly).write.mode("overwrite").parquet(f"{folder}/anomalies/batch={number}")
        kept.unpersist()

    run_through(stream.writeStream.outputMode("append").foreachBatch(write), spark, folder, keyed)
    return tuple(written(spark, f"{folder}/{name}", stream.schema, "/*") for name in ("history", "anomalies"))


def run_upserts(stream: DataFrame, folder: str, key: Sequence[str], order: str, mode: str = "update", partitions: int = 16) -> DataFrame:
    """Run all that is there into an ``UpsertTable`` and return its rows."""
    table = UpsertTable(f"{folder}/table", key, order, partitions)
    run_through(stream.writeStream.outputMode(mode).foreachBatch(table.write), stream.sparkSession, folder)
    return table.read(stream.sparkSession, stream.schema)
