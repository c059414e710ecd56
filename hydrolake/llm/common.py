"""Shared helpers of the training-data operators: tables, shared storage, bounded collection."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space that parts words (space, tab to carriage return).
SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()
ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors this package as a zip that Spark distributes, once per application.

    So tasks can import it wherever they run, also when the driver's working folder isn't theirs. Whole texts are long
    rows: unless the session says otherwise, Python tasks get them in batches of 1000 rows, not 10000.
    """
    if spark.conf.get(ROWS_PER_BATCH) == "10000":
        spark.conf.set(ROWS_PER_BATCH, "1000")
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if sc.applicationId in _SHIPPED or not root.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="spark-package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local master (tests) gets a temporary folder; a cluster, whose executors don't share the
    driver's disk, gets an error.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(known)
    return known.rstrip("/")


_WRITTEN: dict[str, list[str]] = {}  # paths by application
_TABLES: dict[str, list[str]] = {}  # names of bucketed tables by application


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_written(spark: SparkSession) -> int:
    """Remove what this application's operators have written to the shared folder; how many paths that were.

    Results that were not saved yet still need it, so call it when all is saved.
    """
    app = spark.sparkContext.applicationId
    for name in _TABLES.pop(app, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths = _WRITTEN.pop(app, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remove_table(df: DataFrame) -> None:
    """Remove the files of a table that ``materialize`` wrote and nothing reads any more."""
    spark = df.sparkSession
    written = _WRITTEN.get(spark.sparkContext.applicationId, [])
    for path in [p for p in written if any(p.rsplit("/", 1)[1] in f for f in df.inputFiles()[:1])]:
        written.remove(path)
        _delete(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_buckets(spark: SparkSession, n_bytes: int, bucket_bytes: int) -> int:
    """Buckets of a table of ``n_bytes``: at least as many as a shuffle has partitions, or a join would shuffle the table
    for more parallelism, and at most as many as Spark allows."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // bucket_bytes)))


def materialize_bucketed(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """As ``materialize``, but bucketed by a column: joins with rows partitioned alike don't shuffle this table.

    Give it rows that are read from a written table, so that a repeated task deals the same rows.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    table_name = path.rsplit("/", 1)[1].replace("-", "_")
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(table_name)
    df.repartition(buckets, by).write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, by).saveAsTable(table_name)
    return spark.table(table_name)


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs whose results are written.

    It does so when the driver's garbage is collected, which a long job on a large heap may never need for itself, so
    that its disks fill with files that nobody reads again.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def whole_text(col: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table whose size is bounded by its meaning; fail rather than cut it if the bound is broken."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows
