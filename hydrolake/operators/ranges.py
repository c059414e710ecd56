"""Running sums, running maxima, numbers and exact quantiles within keys, without a task that holds a whole key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType

from hydrolake.sources.shared import fresh_path


def _measure(df: DataFrame, order: str) -> Callable[[Column], Column]:
    """What turns values of the column into doubles in the same order: a moment without a zone counts by its day."""
    kind = df.schema[order].dataType
    if isinstance(kind, (DateType, TimestampNTZType)):
        return lambda c: F.unix_date(c.cast("date")).cast("double")
    return lambda c: c.cast("double")


def parted(df: DataFrame, by: Sequence[str], order: str, parts: int = 200, rows: int = 1_000_000) -> DataFrame:
    """``df`` with _part: which of the key's ranges of ``order`` (a number or a time) a row is in, by cuts from the quantile
    sketch of the key. Rows with equal keys and order are in one range, rows without order in the first.

    A key of more than ``parts`` * ``rows`` rows has each range divided evenly between its ends, into as many as bring
    it to about ``rows`` rows, so ranges grow in number with the key and not in size.

    The cuts, a row per key, are written and read back: a sketch depends on the order in which its parts arrive and are
    merged, so cuts that are computed anew for each use may differ between uses.
    """
    of, spread = _measure(df, order), F.percentile_approx(order, [i / parts for i in range(1, parts)], F.lit(10 * parts))
    cuts = df.groupBy(*by).agg(
        F.concat(F.array(F.min(order)), spread, F.array(F.max(order))).alias("_ends"), F.ceil(F.count(F.lit(1)) / (parts * rows)).alias("_finer")
    )
    path = fresh_path(df.sparkSession, "cuts")
    cuts.write.parquet(path)
    cuts = df.sparkSession.read.schema(cuts.schema).parquet(path)
    below = F.size(F.filter("_ends", lambda c: c < F.col(order)))  # the key's least value is one of the ends
    x = df.join(cuts, list(by)).withColumn("_part", F.greatest(F.lit(0), below - 1).cast("long"))
    low, high = (of(F.get("_ends", (F.col("_part") + k).cast("int"))) for k in (0, 1))
    inside = F.floor((of(F.col(order)) - low) / F.nullif(high - low, F.lit(0.0)) * F.col("_finer"))
    finer = F.greatest(F.lit(0), F.least(F.coalesce(inside, F.lit(0)), F.col("_finer") - 1))
    return x.withColumn("_part", F.when(F.col("_finer") > 1, F.col("_part") * F.col("_finer") + finer).otherwise(F.col("_part"))).drop("_ends", "_finer")


def running_before(df: DataFrame, by: Sequence[str], order: str, cols: Mapping[str, str], parts: int = 200, ties: Sequence[str] = (), rows: int = 1_000_000) -> DataFrame:
    """``df`` with <col>_before: the ``sum`` or ``max`` of each column over the key's rows before this one.

    ``order`` is a number or a time, distinct per key or else told apart by ``ties``. A key's rows are dealt to ranges of
    ``order`` (cuts from its quantile sketch), added up per range, and ordered within a range only, so a key that holds
    most of the table is spread over many tasks. Without a row before, a sum is 0 and a maximum null.
    """
    keys = list(by) or ["_all_rows"]
    x = parted(df if by else df.withColumn("_all_rows", F.lit(0)), keys, order, parts, rows)
    call = {"sum": F.sum, "max": F.max}
    per = x.groupBy(*keys, "_part").agg(*[call[f](c).alias(f"_s_{c}") for c, f in cols.items()])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(*keys, "_part", *[call[f](f"_s_{c}").over(before).alias(f"_o_{c}") for c, f in cols.items()])
    inside = Window.partitionBy(*keys, "_part").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    out = x.join(offsets, [*keys, "_part"])

    def joined(c: str, f: str) -> Column:
        own, earlier = call[f](c).over(inside), F.col(f"_o_{c}")
        return F.coalesce(earlier, F.lit(0)) + F.coalesce(own, F.lit(0)) if f == "sum" else F.greatest(earlier, own)

    out = out.withColumns({f"{c}_before": joined(c, f) for c, f in cols.items()})
    return out.drop("_part", *[f"_o_{c}" for c in cols], *([] if by else keys))


def numbered(df: DataFrame, by: Sequence[str], order: str, name: str, ties: Sequence[str] = ()) -> DataFrame:
    """``df`` with the row's number within its key from 1."""
    x = running_before(df.withColumn("_one", F.lit(1).cast("long")), by, order, {"_one": "sum"}, ties=ties)
    return x.withColumn(name, F.col("_one_before") + 1).drop("_one", "_one_before")


def with_count(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``df`` with the number of its key's rows; counts are partial before the shuffle."""
    if not by:
        return df.withColumn(name, F.lit(df.count()))
    return df.join(df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)), list(by))


def hashed(*parts) -> tuple[Column, Column]:
    """A random but fixed order: a number of 32 bits to sort by, and the whole hash for ties. Other engines have it too."""
    h = F.md5(F.concat_ws(":", *[F.lit(p).cast("string") if isinstance(p, int) else F.col(p).cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), h


def exact_quantile(df: DataFrame, by: Sequence[str], value: str, level: Column, name: str = "q") -> DataFrame:
    """``by``, the linear-interpolated quantile of ``value`` at ``level`` (an expression of n, the key's values), and n.

    The two order statistics are found from counts per distinct value and their running sums. Nulls don't count.
    """
    keys = list(by) or ["_all_rows"]
    rows = df if by else df.withColumn("_all_rows", F.lit(0))
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_s")).agg(F.count(F.lit(1)).alias("_k"))
    x = running_before(counts, keys, "_s", {"_k": "sum"}).join(counts.groupBy(*keys).agg(F.sum("_k").alias("n")), keys)
    x = x.withColumn("_at", level * (F.col("n") - 1) + 1)
    holds = lambda r: (F.col("_k_before") < r) & (r <= F.col("_k_before") + F.col("_k"))
    lo, hi = (F.max(F.when(holds(f("_at")), F.col("_s"))) for f in (F.floor, F.ceil))
    out = x.groupBy(*keys).agg(lo.alias("_lo"), hi.alias("_hi"), F.max("_at").alias("_at"), F.max("n").alias("n"))
    return out.select(*by, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at"))).alias(name), "n")
