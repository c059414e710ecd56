"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Benchmark items become windows of consecutive words. A block is two words. The shift table says how far a window's end
may move when a block is seen there; most blocks of a document occur in no window, so the search jumps almost a
whole window at a time. Where the shift is zero, the suffix bucket of that block lists the windows to compare
directly. Benchmark items are searched in blocks of a bounded size, one pass over the documents per block.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolake.llm.common import materialize, whole_text

#: Fixed value: a word, after A-Z are lower-cased, as UTF-8 bytes: digits, letters, and all that isn't ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())  # bytes.lower() touches A-Z alone


class WuManber:
    """Windows of one length m >= 1 with their items."""

    def __init__(self, m: int, windows: dict[tuple[bytes, ...], list[str]]):
        self.m, self.b = m, min(2, m)
        self.default = m - self.b + 1
        self.shift: dict = {}
        self.bucket: dict = defaultdict(list)
        for window, items in windows.items():
            for end in range(self.b, m + 1):
                block = window[end - self.b : end]
                self.shift[block] = min(self.shift.get(block, self.default), m - end)
            self.bucket[window[-self.b :]].append((window, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start and items of every occurrence."""
        m, b, shift, default, i, n = self.m, self.b, self.shift, self.default, self.m, len(words)
        while i <= n:
            block = tuple(words[i - b : i])
            step = shift.get(block, default)
            if step:
                i += step
                continue
            at = i - m
            here = tuple(words[at:i])
            for window, items in self.bucket[block]:
                if window == here:
                    yield at, items
            i += 1


def item_windows(text: str, size: int) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def searchers(items: list[tuple[str, str]], size: int) -> list[WuManber]:
    by_length: dict = defaultdict(lambda: defaultdict(list))
    for item_id, text in items:
        for window in item_windows(text, size):
            by_length[len(window)][window].append(item_id)
    return [WuManber(m, windows) for m, windows in sorted(by_length.items())]


def item_blocks(benchmark: DataFrame, max_chars: int) -> Iterator[list[tuple[str, str]]]:
    """Benchmark items in blocks of at most ``max_chars`` (one item at least): what one pass broadcasts."""
    block: list[tuple[str, str]] = []
    chars = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).where("i is not null and t is not null").orderBy("i", "t")
    for row in rows.toLocalIterator():
        if block and chars + len(row["t"]) > max_chars:
            yield block
            block, chars = [], 0
        block.append((row["i"], row["t"]))
        chars += len(row["t"])
    yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, max_chars: int = 4_000_000, keep: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """One row per document: ``keep`` columns, n_words, n_hit, items (sorted array of item ids found); with_text: and _whole,
    the text with null as empty.

    Null or empty text: no words. Null items are skipped; equal items are all reported; repeated documents each get
    their row. Usually one block holds the whole benchmark: one pass over the rows without a shuffle. With more, each
    block's pass is written before the next begins, so an executor holds one block's tables at a time.
    """
    keep = ["doc_id"] if keep is None else keep
    state = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], whole_text().alias("_text"),
        F.array().cast("array<string>").alias("_items"), F.array().cast("array<long>").alias("_runs"), F.lit(0).cast("long").alias("_n"), F.lit(0).cast("long").alias("_hit"),
    )
    before = None
    for block in item_blocks(benchmark, max_chars):
        if before is not None:
            state = materialize(state, "decontaminated")
            before.unpersist()
        before = state.sparkSession.sparkContext.broadcast(block)
        state = _one_pass(state, before, window)
    return state.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_n").alias("n_words"),
        F.col("_hit").alias("n_hit"), F.col("_items").alias("items"),
        *[F.col("_text").alias("_whole")] * with_text,
    )


_BUILT: dict[str, list[WuManber]] = {}


def built_searchers(number: str, items: list[tuple[str, str]], size: int) -> list[WuManber]:
    """The tables of a block, built once in a worker; those of another block make room."""
    if number not in _BUILT:
        _BUILT.clear()
        _BUILT[number] = searchers(items, size)
    return _BUILT[number]


def _one_pass(state: DataFrame, block: Broadcast, window: int) -> DataFrame:
    names, number = state.columns, f"{uuid.uuid4().hex}-{window}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = built_searchers(number, block.value, window)
        for batch in batches:
            texts, before, ran = (batch.column(names.index(c)).to_pylist() for c in ("_text", "_items", "_runs"))
            n_words, n_hit, which, runs = [], [], [], []
            for text, old_items, old_runs in zip(texts, before, ran, strict=True):
                words = words_of(text)
                spans, ids = list(zip(old_runs[::2], old_runs[1::2], strict=True)), set(old_items)
                for s in found:
                    for at, hit in s.search(words):
                        spans.append((at, at + s.m))
                        ids.update(hit)
                n_words.append(len(words))
                which.append(sorted(ids))
                merged = merge_runs(spans)
                n_hit.append(sum(b - a for a, b in merged))
                runs.append([x for r in merged for x in r])
            new = {"_hit": pa.array(n_hit, pa.int64()), "_items": pa.array(which, pa.list_(pa.string())), "_runs": pa.array(runs, pa.list_(pa.int64())), "_n": pa.array(n_words, pa.int64())}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(i)) for i, c in enumerate(names)], names=names)

    return state.mapInArrow(run, state.schema)


def merge_runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out
