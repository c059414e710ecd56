"""Quality rules with adaptive thresholds (DataFrame functions only).

Every document gets a few ratios. A mergeable quantile sketch of each ratio is built per language and source, merged per
language and over all. A sketch counts values in bins whose edges grow by a fixed factor (zero has a bin of its own), so
its quantiles are right to that factor, merging is adding, and every run gives the same. The quartiles of small groups
lean on the language's, and these on all documents', in proportion to counts. A fence lies some spreads (the distance of
the quartiles) beyond its group's quartile: a clean group loses nothing, one with a share of bad text loses that share.
A group that is bad throughout has wide quartiles of its own, so a fence may be beyond that of its language (and this
beyond that of all documents) by as much as the latter lies beyond its quartile, and no more. Fences are joined to the
documents' ratios.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrolake.llm.common import SPACE, materialize, whole_text

POSITION_BITS = 21  # of a packed (hash, position); longer documents sort pairs instead
LOW = (1 << POSITION_BITS) - 1


@dataclass(frozen=True)
class AdaptiveRule:
    """A ratio is unusual above its group's upper fence or, if ``both``, below the lower one. ``spread``: what the
    distance of the quartiles counts as at least, for groups of nearly equal values."""

    name: str
    spread: float
    both: bool = False


RULES = (AdaptiveRule("symbol_ratio", 0.02), AdaptiveRule("dup_line_ratio", 0.1), AdaptiveRule("repeat_ratio", 0.05), AdaptiveRule("mean_word", 0.25, both=True))
REACH = 3.0  # spreads from a quartile to its fence
QUARTER = 250  # of a thousand
GROWTH = 1.02  # of the sketch's bin edges
ZERO_BIN = -(1 << 30)


def _repeat_positions(hashes: Column, ordered: Column, position, same) -> Column:
    """Sorted starts of windows that are equal to a neighbour in ``ordered``."""
    last = F.size(ordered) - 1
    equal = F.filter(
        ordered,
        lambda x, j: F.when(j > 0, same(x, F.get(ordered, j - 1))).otherwise(False) | F.when(j < last, same(x, F.get(ordered, j + 1))).otherwise(False),
    )
    return F.sort_array(F.transform(equal, position))


def _covered(starts: Column) -> Column:
    """Words in the union of 3-word windows at sorted starts."""
    first = F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(starts, first, lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n")))["n"]


def text_measures(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of every whole text.

    Repeated windows are found in the row: 64-bit hashes of the 3-word windows, packed with their position and sorted,
    put equal windows side by side. Null text has no words. Nothing is shuffled.
    """
    text = F.col("_text")
    words = F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+"), F.lit(0))
    w = lambda i: F.get(F.col("_words"), i)
    few = F.array().cast("array<long>")
    hashes = F.when(F.size("_words") < 3, few).otherwise(
        F.transform(F.sequence(F.lit(0), F.size("_words") - 3), lambda i: F.xxhash64(w(i), w(i + 1), w(i + 2)))
    )
    packed = F.sort_array(F.transform("_hashes", lambda h, i: h.bitwiseAND(F.lit(~LOW)).bitwiseOR(i.cast("long"))))
    at = lambda x: x.bitwiseAND(F.lit(LOW)).cast("int")
    high = lambda x: x.bitwiseAND(F.lit(~LOW))
    whole = lambda x: F.get(F.col("_hashes"), at(x))
    # equal upper bits of unequal windows could part equal windows; such a text (or a very long one) sorts pairs
    unsure = (F.size("_hashes") > LOW) | F.exists(
        F.sequence(F.lit(1), F.greatest(F.size("_packed") - 1, F.lit(1))),
        lambda j: F.coalesce((high(F.get(F.col("_packed"), j)) == high(F.get(F.col("_packed"), j - 1))) & (whole(F.get(F.col("_packed"), j)) != whole(F.get(F.col("_packed"), j - 1))), F.lit(False)),
    )
    fast = _repeat_positions(F.col("_hashes"), F.col("_packed"), at, lambda a, b: high(a) == high(b))
    pairs = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i"))))
    slow = F.when(F.size("_pairs") > 0, _repeat_positions(F.col("_hashes"), F.col("_pairs"), lambda x: x["i"], lambda a, b: a["h"] == b["h"])).otherwise(F.array().cast("array<int>"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit(f"[^{SPACE}]")))
    step = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], whole_text().alias("_text"))
    step = step.withColumns({"_words": words, "_lines": lines})
    step = step.withColumns(
        {
            "_hashes": hashes,
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.aggregate("_words", F.lit(0).cast("long"), lambda a, x: a + F.length(x)),
            "n_symbols": (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    ).drop("_text", "_words", "_lines")
    step = step.withColumn("_packed", packed).withColumn("_unsure", unsure)
    step = step.withColumn("_pairs", F.when(F.col("_unsure"), pairs))
    step = step.withColumn("n_repeat_words", _covered(F.when(F.col("_unsure"), slow).otherwise(fast)))
    return step.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def with_ratios(measures: DataFrame) -> DataFrame:
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)).cast("double")
    return measures.withColumns(
        {"symbol_ratio": per("n_symbols", "word_chars"), "dup_line_ratio": per("n_dup_lines", "n_lines"), "repeat_ratio": per("n_repeat_words", "n_words"), "mean_word": per("word_chars", "n_words")}
    )


def group_sketches(ratios: DataFrame, by: Sequence[str], rules: Sequence[AdaptiveRule]) -> DataFrame:
    """``by``, rule (its place), bin, n: the sketches as rows; counts are partial before the shuffle, so a hot group costs no more."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), F.col(r.name).alias("x")) for i, r in enumerate(rules)])).alias("r")
    bin_of = F.when(F.col("r.x") > 0, F.ceil(F.ln("r.x") / math.log(GROWTH)).cast("int")).otherwise(ZERO_BIN)
    return ratios.select(*by, each).groupBy(*by, F.col("r.rule").alias("rule"), bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    return sketches.groupBy(*by, "rule", "bin").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, by: Sequence[str], rules: Sequence[AdaptiveRule], prefix: str) -> DataFrame:
    """``by`` with the prefix, and a struct ``prefix`` of n and a (low, high) pair for each rule.

    high is the upper edge of the bin in which the upper quartile lies, low the lower edge of the lower quartile's. A
    sketch has a few thousand bins at most, so no window is large.
    """
    key = [*by, "rule"]
    running = sketches.withColumn("_upto", F.sum("n").over(Window.partitionBy(*key).orderBy("bin"))).withColumn("_all", F.sum("n").over(Window.partitionBy(*key)))
    reached = lambda share: F.min(F.when(1000 * F.col("_upto") >= share * F.col("_all"), F.col("bin")))
    found = running.groupBy(*key).agg(reached(1000 - QUARTER).alias("_high"), reached(QUARTER).alias("_low"), F.first("_all").alias("_n"))
    edge = lambda b, down: F.when(b > ZERO_BIN, F.pow(F.lit(GROWTH), b - down)).otherwise(0.0)
    pair = [
        F.max(F.when(F.col("rule") == i, F.struct(edge(F.col("_low"), 1).alias("low"), edge(F.col("_high"), 0).alias("high")))).alias(r.name)
        for i, r in enumerate(rules)
    ]
    wide = found.groupBy(*by).agg(F.max("_n").alias("n"), *pair)
    return wide.select(*[F.col(c).alias(f"{prefix}{c}") for c in by], F.struct("n", *[r.name for r in rules]).alias(prefix))


def judge_quality(docs: DataFrame, keep: Sequence[str] = ("doc_id",), by: tuple[str, str] = ("lang", "source"), rules: Sequence[AdaptiveRule] = RULES, reach: float = REACH, prior_rows: int = 100) -> DataFrame:
    """``keep`` columns, the measures, base_failed, kept, failed_rules for every row of ``docs``.

    Thresholds come from all documents that pass the base rules: fences ``reach`` spreads beyond the quartiles of their
    language and source, whose quartiles count for the group's number of documents against ``prior_rows`` for the
    language's; the language's count alike against those of all documents. Null language or source is a group like
    others; null text fails the base rule. With no document that passes, only the base rule decides. Extra columns are
    ignored.
    """
    measures = text_measures(docs, [*keep, *by])
    n_keep = len(keep)
    # measured once: the ratios are read for the sketches and for the verdict
    plain = [f"_c{i}" for i in range(n_keep)] + ["_lang", "_source"]
    measured = materialize(with_ratios(measures.toDF(*plain, *measures.columns[n_keep + 2 :])), "measures").withColumn("base_failed", base_failed())
    fine = materialize(group_sketches(measured.where(~F.col("base_failed")), ["_lang", "_source"], rules), "sketches")
    middle = merged_sketches(fine, ["_lang"])
    a, b = quartiles(fine, ["_lang", "_source"], rules, "a"), quartiles(merged_sketches(fine, ["_lang"]), ["_lang"], rules, "b")
    overall = quartiles(merged_sketches(fine.withColumn("_one", F.lit(1)), ["_one"]), ["_one"], rules, "c").first()  # a row at most

    def leaning(own: str, parent: Column, r: AdaptiveRule, side: str) -> Column:
        count = F.col(f"{own}.n").cast("double")
        return (count * F.col(f"{own}.{r.name}.{side}") + prior_rows * parent) / (count + prior_rows)

    def both_fences(r: AdaptiveRule) -> list[Column]:
        """The group's fences from the quartiles of all, its language and itself, each leaning on those before."""
        quarter = {side: F.lit(float(overall["c"][r.name][side]) if overall else None) for side in ("low", "high")}
        low = high = width = None
        for own in ("c", "b", "a"):
            if own != "c":
                quarter = {side: leaning(own, quarter[side], r, side) for side in quarter}
            before, width = width, reach * F.greatest(quarter["high"] - quarter["low"], F.lit(r.spread))
            least, most = quarter["low"] - width, quarter["high"] + width
            low, high = (least, most) if before is None else (F.greatest(least, low - before), F.least(most, high + before))
        return [low.alias(f"low_{r.name}"), high.alias(f"high_{r.name}")]

    # a row per group with its final fences, then one join
    final = a.join(b, F.col("a_lang").eqNullSafe(F.col("b_lang"))).select("a_lang", "a_source", *[f for r in rules for f in both_fences(r)])
    judged = measured.join(final, F.col("_lang").eqNullSafe(F.col("a_lang")) & F.col("_source").eqNullSafe(F.col("a_source")), "left")
    beyond = lambda r: (F.col(r.name) > F.col(f"high_{r.name}")) | ((F.col(r.name) < F.col(f"low_{r.name}")) if r.both else F.lit(False))
    failed = F.array_compact(F.array(*[F.when(beyond(r), F.lit(r.name)) for r in rules]))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged.withColumn("failed_rules", failed).select(
        *[F.col(f"_c{i}").alias(name) for i, name in enumerate(keep)], *names,
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules",
    )
