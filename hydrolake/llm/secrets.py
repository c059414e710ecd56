"""Secret scans by a trigram inverted index (DataFrame functions only).

Each rule's regex gives a Boolean query over the trigrams its matches must hold: an AND of factors, each an OR of
strings, each an AND of that string's trigrams. The index, a table in the shared folder, has one posting row (trigram,
document) for each trigram of the rules that a document holds. Intersecting postings by document leaves the candidates of
each rule, and these alone run the regex. A rule without mandatory trigrams scans every document. An index can be kept:
later scans read its postings and the candidates, and new rules add the postings that they lack.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from re import _constants as op  # the standard library's own regex parser
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolake.llm.common import fresh_path, materialize, whole_text
from hydrolake.llm.url_filter import build_level

MOST_STRINGS = 64
CHUNK = 256  # matches summed together
FILTERED = 8 << 20  # candidates in a Bloom filter of theirs, at most: ten bits each


@dataclass(frozen=True)
class SecretRule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` is shorter than ``min_length`` are dropped."""

    kind: str
    pattern: str
    group: int
    min_length: int
    base: bool = True


#: The three base kinds, in the order that ties are listed.
BASE_RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Spans that the method adds to the base ones.
MORE_RULES = (SecretRule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1, base=False),)


def _strings(tree) -> list[set[str] | None]:
    """A regex as a sequence of pieces: a finite set of strings (lower case), or None for anything else."""
    out: list[set[str] | None] = []
    for code, arg in tree:
        if code is op.LITERAL:
            out.append({chr(arg).lower()})
        elif code is op.IN and len(arg) <= 4 and all(k is op.LITERAL for k, _ in arg):
            out.append({chr(c).lower() for _, c in arg})
        elif code is op.SUBPATTERN:
            out += _strings(arg[3])
        elif code is op.BRANCH:
            options = [_whole(x) for x in arg[1]]
            out.append(None if None in options else set().union(*options))
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[1] == 1 and arg[0] <= 1:
            inner = _whole(arg[2])
            out.append(None if inner is None else inner | ({""} if arg[0] == 0 else set()))
        elif code in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] >= 1 and (inner := _whole(arg[2])) is not None:
            out += [*[inner] * min(arg[0], 3), None]
        elif code is not op.AT:
            out.append(None)
    return out


def _whole(tree) -> set[str] | None:
    """All strings of a piece, if they are few."""
    found = {""}
    for piece in _strings(tree):
        if piece is None or len(found) * len(piece) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in piece}
    return found


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """AND of factors; a factor is an OR of trigram lists (AND). Empty: no mandatory trigram."""
    factors, run = [], {""}

    def close() -> None:
        options = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
        if all(options):
            least = [x for x in options if not any(y < x for y in options)]
            factors.append(sorted(sorted(x) for x in least))

    for piece in _strings(_parser.parse(pattern)):
        if piece is None or len(run) * len(piece) > MOST_STRINGS:
            close()
            run = {""} if piece is None else set(piece)
        else:
            run = {a + b for a in run for b in piece}
    close()
    return factors


def text_key() -> Column:
    """Tells rows with one key (or none) apart, and spreads them."""
    return F.xxhash64(whole_text()).alias("_tk")


def postings(docs: DataFrame, trigrams: Sequence[str], key: str = "doc_id") -> DataFrame:
    """The inverted index over the given trigrams, folded to lower case: (trigram, _key, _tk), a row per document that holds it."""
    # the folded text is bound once, not once for each trigram
    held = F.get(F.transform(F.array(F.lower(whole_text())), lambda f: F.filter(F.array(*map(F.lit, trigrams)), lambda g: F.contains(f, g))), F.lit(0))
    return docs.select(F.col(key).alias("_key"), text_key(), F.explode(held).alias("trigram"))


def meets(query: list[list[list[str]]], holds: Callable[[str], Column]) -> Column:
    """The Boolean query; ``holds`` tests one trigram."""
    every = F.lit(True)
    for factor in query:
        some = F.lit(False)
        for option in factor:
            some = some | reduce(and_, map(holds, option))
        every = every & some
    return every


def candidates(index: DataFrame, queries: dict[str, list]) -> DataFrame:
    """(_key, _tk, _kinds) of the documents whose postings meet a rule's query."""
    # intersection by document: the set of its trigrams has at most one entry for each trigram of the rules
    held = index.groupBy("_key", "_tk").agg(F.collect_set("trigram").alias("_held"))
    kinds = F.array_compact(F.array(*[F.when(meets(q, lambda g: F.array_contains("_held", g)), F.lit(k)) for k, q in queries.items()]))
    return held.select("_key", "_tk", kinds.alias("_kinds")).where(F.size("_kinds") > 0)


def match_spans(text: Column, rule: SecretRule, order: int) -> Column:
    """Array of (s, o, e, kind): code point offsets of the rule's matches, end exclusive.

    The parts between matches and the matches themselves take turns, so their running lengths are the offsets. They are
    summed in chunks and the chunks moved to their places, as an array that grows match by match is copied each time.
    """
    pattern = F.lit(rule.pattern)
    parts, whole = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    tested = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.arrays_zip(F.transform(parts, F.length).alias("gap"), F.transform(whole, F.length).alias("len"), F.transform(tested, F.length).alias("own"))
    span = "struct<s:int,o:int,e:int,kind:string>"
    span_of = lambda s, e: F.struct(s.alias("s"), F.lit(order).alias("o"), e.alias("e"), F.lit(rule.kind).alias("kind"))

    def start(kind: str) -> Column:
        return F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + F.coalesce(x["len"], F.lit(0))
        return F.struct(e.alias("at"), F.when(x["own"] >= rule.min_length, F.array_append(acc["out"], span_of(s, e))).otherwise(acc["out"]).alias("out"))

    def move(acc: Column, x: Column) -> Column:
        moved = F.transform(x["out"], lambda m: span_of(m["s"] + acc["at"], m["e"] + acc["at"]))
        return F.struct((acc["at"] + x["at"]).alias("at"), F.array_append(acc["out"], moved).alias("out"))

    def summed(every: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / CHUNK).cast("int")), lambda i: F.aggregate(F.slice(every, i * CHUNK + 1, F.lit(CHUNK)), start(span), step))
        return F.flatten(F.aggregate(chunks, start(f"array<{span}>"), move)["out"])

    found = F.get(F.transform(F.array(steps), summed), F.lit(0))  # the steps are bound once
    return F.when(F.size(whole) == 0, F.array().cast(f"array<{span}>")).otherwise(found)


@dataclass(frozen=True)
class TrigramIndex:
    """Postings of some trigrams over a corpus, in a folder that later scans read again."""

    path: str
    trigrams: tuple[str, ...]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def vocabulary(rules: Sequence[SecretRule]) -> list[str]:
    return sorted({g for r in rules for f in trigram_query(r.pattern) for option in f for g in option})


def build_index(docs: DataFrame, rules: Sequence[SecretRule], path: str, key: str = "doc_id") -> TrigramIndex:
    """Write the postings of the rules' trigrams. Rules whose trigrams are among them can be scanned by it later."""
    trigrams = vocabulary(rules)
    postings(docs, trigrams, key).write.option("compression", "zstd").parquet(path)
    return TrigramIndex(path, tuple(trigrams))


def extend_index(docs: DataFrame, index: TrigramIndex, rules: Sequence[SecretRule], key: str = "doc_id") -> TrigramIndex:
    """Add the postings of new rules' trigrams that the index hasn't; the corpus is read for these alone."""
    more = [g for g in vocabulary(rules) if g not in index.trigrams]
    if more:
        postings(docs, more, key).write.mode("append").option("compression", "zstd").parquet(index.path)
    return TrigramIndex(index.path, (*index.trigrams, *more))


def scan_secrets(docs: DataFrame, rules: Sequence[SecretRule] = BASE_RULES + MORE_RULES, key: str = "doc_id", keep: Sequence[str] = ("doc_id",), index: TrigramIndex | None = None) -> DataFrame:
    """``keep`` columns and found: array of (s, o, e, kind), sorted, for every row of ``docs``.

    The candidates of a rule come from the index: a given one of the same ``docs``, or one that is built for this scan.
    Texts go to meet the candidates, but for those that a Bloom filter of the candidates (its size is checked) rules out.

    Null text counts as empty. Rows with equal or null keys are told apart by a hash of their texts; equal rows get
    equal spans. Extra columns are ignored.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    none = F.array().cast("array<struct<s:int,o:int,e:int,kind:string>>")
    plain = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(key).alias("_row"), text_key(), whole_text().alias("_text"))
    scanned = [match_spans(F.col("_text"), r, i) for i, r in enumerate(rules) if r.kind not in indexed]
    rows = plain.select(*[f"_k{i}" for i in range(len(keep))], "_row", "_tk", F.concat(none, *scanned).alias("_scanned"))
    if indexed:
        spark, own = docs.sparkSession, [r for r in rules if r.kind in indexed]
        index = index or build_index(docs, own, fresh_path(spark, "postings"), key)
        if unknown := set(vocabulary(own)) - set(index.trigrams):
            raise ValueError(f"the index has no postings of {sorted(unknown)}; see extend_index")
        found = materialize(candidates(index.read(spark), indexed), "candidates")
        n_found = found.count()
        texts = plain
        if n_found <= FILTERED:  # beyond it, all texts are moved
            texts = texts.where(build_level(found.select(F.col("_tk").alias("key")), n_found, 0.01, 0, FILTERED * 2).might_contain(F.col("_tk")))
        texts = texts.select("_row", F.col("_tk").alias("_t"), "_text").join(found, F.col("_row").eqNullSafe(F.col("_key")) & (F.col("_t") == F.col("_tk")))
        spans = [F.when(F.array_contains("_kinds", r.kind), match_spans(F.col("_text"), r, i)).otherwise(none) for i, r in enumerate(rules) if r.kind in indexed]
        checked = texts.select(F.col("_row").alias("_of"), "_t", F.concat(*spans).alias("_checked")).where(F.size("_checked") > 0).dropDuplicates(["_of", "_t"])
        rows = rows.join(checked, F.col("_row").eqNullSafe(F.col("_of")) & (F.col("_tk") == F.col("_t")), "left")
    else:
        rows = rows.withColumn("_checked", none)
    both = F.concat("_scanned", F.coalesce("_checked", none))
    return rows.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.array_sort(both).alias("found"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: the digest of what scan_secrets finds."""
    base = [r.kind for r in BASE_RULES]
    found = scan_secrets(docs)
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *map(count, base),
        F.sha2(span_text(F.filter("found", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"),
    )
