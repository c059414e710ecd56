"""Grouping of spelling variants by PartEnum signatures.

A word is a set of letters with their repeat numbers (the third "e" is another element than the first), a binary vector.
One inserted or deleted letter changes one bit of it, a replaced letter two at most, so near words have vectors within a
Hamming distance of two. PartEnum: the bits are partitioned into PARTS parts, and each choice of PARTS - 2 of them gives a
signature, the vector's bits in the chosen parts. Vectors within distance two agree in all but two parts, so they share
a signature: an equi-join on signatures finds every near pair, and the words themselves verify it.

Letters alone say too little where syllables repeat, so a signature is split by the halves of the word: one edit leaves
the front or the back half of the shorter word as it is. That splits each group of equal signatures, also a hot one, and
loses no pair.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolake.llm.common import bounded_rows, materialize, ship

PARTS = 4
DISTANCE = 2
COUNTED = 200_000  # distinct words that a task counts before it passes them on
ALPHABET = 200  # letters that the word pattern can match, at most

Prepare = Callable[[int | None, str], str]


def count_words(docs: DataFrame, least_length: int, prepare: Prepare | None = None) -> DataFrame:
    """word, n: how often each word of at least ``least_length`` letters occurs in all texts.

    Words are the longest runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased. ``prepare`` gets the doc_id and a word
    and returns the word to count (the same for all of a document's equal words), which must be long enough, too.
    """
    runs = re.compile(f"[a-z\\u00C0-\\u00FF]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = Counter(runs.findall((text.as_py() or b"").lower().decode("utf-8", "replace")))
                if prepare:
                    for word, n in own.items():
                        word = prepare(doc_id, word)
                        if len(word) >= least_length:
                            total[word] += n
                else:
                    total.update(own)
                if len(total) >= COUNTED:
                    yield rows(total)
                    total = Counter()
        yield rows(total)

    def rows(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_ranks(words: DataFrame) -> dict[str, int]:
    """Letters by how many there are in the words, the most frequent first, so that parts get equal shares of them."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").count()
    rows = bounded_rows(letters, ALPHABET, "letters")
    return {r["letter"]: k for k, r in enumerate(sorted(rows, key=lambda r: (-r["count"], r["letter"])))}


def halves(word: str) -> set[str]:
    """What may be left whole by one edit, whether the word is the shorter or the longer of its pair."""
    cuts = {len(word) // 2, (len(word) - 1) // 2}
    return {f"<{word[:k]}" for k in cuts} | {f">{word[len(word) - k :]}" for k in cuts}


def vector(word: str, ranks: dict[str, int], parts: int = PARTS) -> tuple[int, list[str]]:
    """64 bits of the word's vector (those of several elements in one place are added up), and its letters by part."""
    bits, own = 0, [""] * parts
    for letter, n in sorted(Counter(word).items()):
        rank = ranks[letter]
        for k in range(n):
            bits ^= 1 << (rank * 7 + k) % 64
            own[(rank + k) % parts] += letter
    return bits - (1 << 64) if bits >> 63 else bits, own


def signatures(words: DataFrame, ranks: dict[str, int], parts: int = PARTS) -> DataFrame:
    """sig, word, n, bits: a row per signature of each word."""
    chosen = list(combinations(range(parts), parts - DISTANCE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sigs, bits = [], [], []
            for k, word in enumerate(batch.column(0).to_pylist()):
                own_bits, own = vector(word, ranks, parts)
                both = halves(word)
                for choice in chosen:
                    said = f"{choice}" + ",".join([own[p] for p in choice])
                    sigs += [xxhash.xxh64_intdigest(said + h) - (1 << 63) for h in both]
                at += [k] * (len(sigs) - len(at))
                bits += [own_bits] * (len(sigs) - len(bits))
            place = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), batch.column(0).take(place), batch.column(1).take(place), pa.array(bits, pa.int64())], names=["sig", "word", "n", "bits"])

    return words.select("word", "n").mapInArrow(run, "sig long, word string, n long, bits long")


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """a, na, b, nb: pairs of words (a < b) that differ by exactly one inserted, deleted or replaced letter, each once."""
    sigs = materialize(signatures(words, letter_ranks(words), parts), "signatures")
    x, y = sigs.toDF("sig", "a", "na", "va"), sigs.toDF("sig", "b", "nb", "vb")
    met = x.join(y, (x["sig"] == y["sig"]) & (F.bit_count(F.col("va").bitwiseXOR(F.col("vb"))) <= DISTANCE) & (F.col("a") < F.col("b")))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "na", "b", "nb").distinct()


def follow(forms: DataFrame) -> DataFrame:
    """word, root: where the forms lead to. The way doubles each round; counts grow tenfold a step, so rounds are few."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.toDF("root", "next")
        step = materialize(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def group_variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, times: int = 10, prepare: Prepare | None = None, parts: int = PARTS) -> DataFrame:
    """word, form, root, n, n_near, form_n for all words of the texts with ``least_count`` occurrences or more.

    form: the near word with the largest n (ties: the smallest by code points), if that is at least ``times`` the word's n;
    else null. root: the end of the chain of forms, the word itself if it has none. Null, empty and wordless texts give no
    words. Counts are over all rows, so repeated rows count as often as they come; null ids count like others; columns
    besides doc_id and text are ignored.
    """
    ship(docs.sparkSession)
    words = materialize(count_words(docs, least_length, prepare).where(F.col("n") >= least_count), "words")
    pairs = materialize(near_pairs(words, parts), "near-words")
    both = pairs.select("a", "na", "b", "nb").union(pairs.select("b", "nb", "a", "na")).toDF("word", "n", "near", "near_n")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"), F.first("n").alias("own"))
    frequent = -F.col("best.order") >= times * F.col("own")
    chosen = materialize(best.select("word", "n_near", F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.order")).alias("form_n")), "forms")
    roots = follow(chosen.where("form is not null"))
    return (
        words.join(chosen, "word", "left").join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )


def plant_typos(doc_id: int | None, word: str) -> str:
    """One in 31 of a document's words, by the CRC-32 of id and word, without one letter; null ids: none."""
    h = zlib.crc32(f"{doc_id}:{word}".encode()) if doc_id is not None else 1
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]
