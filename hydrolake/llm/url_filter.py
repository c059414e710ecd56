"""URL filters by a Bloom filter cascade (DataFrame functions only).

Listed keys are host + path prefixes. Level 0 of the cascade encodes the listed keys; level 1 those keys of the
corpus that level 0 lets through by mistake; level 2 the listed keys that level 1 lets through; and so on until a level
makes no mistake. For every key that occurs in the corpus, asking the levels in turn is exact, so URLs are judged
in their own row: no join with the list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolake.llm.common import bounded_rows, materialize

BUCKET_BITS = 32768  # bits of one bitmap of bitmap_construct_agg


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def key(self) -> str:
        return f"{self.host}{self.path}"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, path_lengths: Sequence[int], depth: int) -> Column:
    """Host suffixes (whole labels, ``depth`` at most, which is what the longest listed host has) x path prefixes of the
    listed lengths, longest host first."""
    labels = F.split(host, r"\.", -1)
    last = F.slice(labels, F.greatest(F.size(labels) - depth + 1, F.lit(1)), F.lit(depth))
    each = lambda own: F.transform(F.sequence(F.lit(1), F.size(own)), lambda i: F.array_join(F.slice(own, i, F.size(own)), "."))
    suffixes = F.get(F.transform(F.array(last), each), F.lit(0))  # the labels are bound once
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(path_lengths, reverse=True)])
    pairs = F.transform(suffixes, lambda s: F.transform(F.array_compact(prefixes), lambda p: F.struct(s.alias("host"), p.alias("path"))))
    return F.flatten(pairs)


def key_text(pair: Column) -> Column:
    return F.concat(pair["host"], pair["path"])


@dataclass(frozen=True)
class Level:
    bits: bytes
    n_bits: int
    n_hashes: int
    seed: int

    def positions(self, key: Column) -> Column:
        """Double hashing: n_hashes bit numbers of a key."""
        return level_positions(key, self.n_bits, self.n_hashes, self.seed)

    def might_contain(self, key: Column) -> Column:
        bits = F.lit(bytearray(self.bits))
        byte = lambda p: F.conv(F.hex(F.substring(bits, (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
        return F.forall(self.positions(key), lambda p: F.getbit(byte(p), (p % 8).cast("int")) == 1)


def level_positions(key: Column, n_bits: int, n_hashes: int, seed: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(seed * 64 + i)), F.lit(n_bits)) for i in range(n_hashes)])


def build_level(keys: DataFrame, n_keys: int, fp_rate: float, seed: int, max_bytes: int) -> Level:
    """One Bloom filter of the column ``key``: bits set by bitmap aggregates, partial before the shuffle.

    Its size is about 1.44 * log2(1 / fp_rate) bits a key, checked against ``max_bytes`` before it goes to the driver.
    """
    per_key = max(1.0, -math.log(fp_rate) / math.log(2) ** 2)
    n_bits = max(BUCKET_BITS, math.ceil(n_keys * per_key / BUCKET_BITS) * BUCKET_BITS)
    n_hashes = max(1, round(-math.log2(fp_rate)))
    if n_bits // 8 > max_bytes:
        raise ValueError(f"a cascade level of {n_keys} keys needs {n_bits // 8} bytes; the bound is {max_bytes}")
    maps = (
        keys.select(F.explode(level_positions(F.col("key"), n_bits, n_hashes, seed)).alias("p"))
        .groupBy((F.col("p") / BUCKET_BITS).cast("int").alias("b"))
        .agg(F.bitmap_construct_agg(F.col("p") % BUCKET_BITS).alias("m"))
    )
    found = {r["b"]: bytes(r["m"]) for r in bounded_rows(maps, n_bits // BUCKET_BITS, "bitmaps of a cascade level")}
    empty = bytes(BUCKET_BITS // 8)
    return Level(b"".join(found.get(b, empty) for b in range(n_bits // BUCKET_BITS)), n_bits, n_hashes, seed)


def in_cascade(levels: Sequence[Level], key: Column) -> Column:
    """Exact membership for keys of the universe: in level 0 and not (in level 1 and not (in level 2 ...))."""
    out = F.lit(False)
    for level in reversed(levels):
        out = level.might_contain(key) & ~out
    return out


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = 64 << 20, max_levels: int = 40) -> list[Level]:
    """Levels over ``listed`` (column key, part of the list) against ``universe`` (column key, distinct).

    Both sides shrink geometrically, so there are about log2 of the universe's size many levels at most. An empty
    list gives no level; a key in neither side isn't judged.
    """
    inside = listed.select("key").where(F.col("key").isNotNull()).distinct()
    outside = universe.select("key").where(F.col("key").isNotNull()).join(inside, "key", "left_anti")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    while n_in and len(levels) < max_levels:
        # the first level's rate makes the expected mistakes about as many as the listed keys
        rate = 0.5 if levels else min(0.5, max(1e-9, n_in / max(1, n_out) / math.sqrt(2)))
        level = build_level(inside, n_in, rate, len(levels), max_bytes)
        levels.append(level)
        wrong = materialize(outside.where(level.might_contain(F.col("key"))), "cascade")
        n_wrong = wrong.count()
        if not n_wrong:
            return levels
        inside, outside, n_in, n_out = wrong, inside, n_wrong, n_in
    if n_in:
        raise ValueError("the cascade doesn't end; use more bits")
    return levels


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url", id_cols: Sequence[str] = ("page_id",)) -> DataFrame:
    """``id_cols``, host, path, rule, verdict, n_keys for every row of ``pages``.

    The longest rule that fits wins (then the longest host). A row without a rule gets ``default``, the cascade's
    verdict of a key that isn't listed. Null URL or none with ``://``: host and path empty, no rule. Repeated rows
    and repeated rules are kept and harmless; of two rules with one key the first counts. Extra columns are ignored.
    """
    spark: SparkSession = pages.sparkSession
    first: dict[str, Rule] = {}
    for r in rules:
        first.setdefault(r.key, r)
    lengths = sorted({len(r.path) for r in first.values()})
    depth = max((r.host.count(".") + 1 for r in first.values()), default=1)
    judged = pages.select(*id_cols, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    if not first:
        none = F.lit(None).cast("string")
        return judged.select(*id_cols, "host", "path", none.alias("rule"), F.lit(default).alias("verdict"), F.lit(0).alias("n_keys"))
    with_keys = judged.withColumn("keys", F.when(F.col("host") == "", F.array().cast("array<struct<host:string,path:string>>")).otherwise(candidate_keys(F.col("host"), F.col("path"), lengths, depth)))
    universe = materialize(with_keys.select(F.explode(F.transform("keys", key_text)).alias("key")).distinct(), "urlkeys")
    as_rows = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.lit(r.verdict).alias("verdict")) for k, r in first.items()])))
    listed_levels = build_cascade(as_rows, universe)
    block_levels = build_cascade(as_rows.where("verdict = 'block'"), as_rows)
    fit = F.filter("keys", lambda p: in_cascade(listed_levels, key_text(p)))
    longest = F.array_sort(
        F.transform(F.col("fit"), lambda p: F.struct((-F.length(key_text(p))).alias("n"), (-F.length(p["host"])).alias("h"), key_text(p).alias("key")))
    )
    return (
        with_keys.withColumn("fit", fit)
        .withColumn("rule", F.get(longest, F.lit(0))["key"])
        .select(
            *id_cols, "host", "path", "rule",
            F.when(F.col("rule").isNull(), F.lit(default)).when(in_cascade(block_levels, F.col("rule")), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
            F.size("keys").alias("n_keys"),
        )
    )
