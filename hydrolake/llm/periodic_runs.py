"""Periodic runs of words by an online sparse diagonal DP.

A run of period d is a diagonal of the table "word i equals word j" with lag i - j = d: as long as word i equals word
i - d, the lag's match length grows by one; when it stops, a length of at least 3 * d (four periods with the first) is
a run and is emitted at once. Only lags that are matching are held (sparse), words are read once (online).

A frequent word has many earlier occurrences, so a lag is only opened where a long diagonal must pass: lags of 2^k to
2^(k+1) - 1 at every 2^k-th word, if more than 2^k words up to there match, and then with its whole length. A diagonal
of 3 * d matches passes three such places, so it is open by the second, and a text of n words looks at n * log(n)
earlier occurrences at most, however often one word stands in it. Within a run of period q, lags that are multiples of
q only end with it, so they aren't opened.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolake.llm.common import ship

Run = tuple[int, int, int]  # start, length, period
Prepare = Callable[[int | None, list[bytes]], list[bytes]]

TIMES = 4  # periods in a run, at least


def find_runs(words: Sequence, least: int = 6) -> list[Run]:
    """All runs of at least ``least`` words and four periods, by start, then period.

    A run is a stretch with smallest period q that no neighbouring word extends; stretches of one start may be several
    runs of different periods.
    """
    n = len(words)
    found: list[Run] = []
    places: dict = {}  # word to its places so far
    active: dict[int, int] = {}  # lag to match length up to the last word

    def end(at: int, ended: list[tuple[int, int]]) -> None:
        """Diagonals that stop before word ``at``; one that a shorter period of the same stretch explains is no run."""
        ended.sort()
        for k, (lag, length) in enumerate(ended):
            if length >= max(least - lag, (TIMES - 1) * lag) and not any(lag % q == 0 and m + q >= length + lag for q, m in ended[:k]):
                found.append((at - length - lag, length + lag, lag))

    for i, word in enumerate(words):
        if active:
            ended = [(lag, length) for lag, length in active.items() if words[i - lag] != word]
            if ended:
                for lag, _ in ended:
                    del active[lag]
                end(i, ended)
            for lag in active:
                active[lag] += 1
        own = places.get(word)
        if own is None:
            places[word] = [i]
            continue
        step, held = 1, None
        while own[-1] > i - 2 * (i & -i) and step <= i and not i % step and TIMES * step <= n:
            if own[-1] > i - 2 * step:
                if held is None:
                    held = [(q, length) for q, length in active.items() if length > q]
                for j in reversed(own[bisect_right(own, i - 2 * step) : bisect_left(own, i - step + 1)]):
                    lag = i - j
                    for q, length in held:
                        if not lag % q and lag < length + q:
                            break
                    else:
                        back = 1
                        while j >= back and words[i - back] == words[j - back]:
                            back += 1
                        if back > step and lag not in active:
                            active[lag] = back
                            held.append((lag, back))
            step *= 2
        own.append(i)
    end(n, list(active.items()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(words: Sequence[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that stand in a run after its first period."""
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period : start + length] = b"\1" * (length - period)
    return [w for w, g in zip(words, gone, strict=True) if not g]


def periodic_runs(docs: DataFrame, least: int = 6, prepare: Prepare | None = None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, n_words, runs (array of start, length, period; by start, then period) and collapsed per row.

    Words are parted by ASCII white space, numbered from 0. ``collapsed`` has the words that no run holds after its first
    period, joined by one space. Null or empty text: no words, no runs, empty ``collapsed``. Texts are judged whole,
    whatever their length; each row by itself, so repeated rows and null ids are rows like others, and columns that
    aren't kept play no part. ``prepare`` gets the doc_id and the words of a row and returns those to judge.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, batch.column(1), strict=True):
                words = (text.as_py() or b"").split()
                words = prepare(doc_id, words) if prepare else words
                runs = find_runs(words, least)
                rows.append((len(words), runs, b" ".join(kept_words(words, runs))))
            flat = [r for _, runs, _ in rows for r in runs]
            at = [0]
            for _, runs, _ in rows:
                at.append(at[-1] + len(runs))
            each = pa.StructArray.from_arrays([pa.array([r[k] for r in flat], pa.int64()) for k in range(3)], names=["start", "length", "period"])
            arrays = [pa.array([r[0] for r in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), each), pa.array([r[2] for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(2), *arrays], names=["_kept", "n_words", "runs", "collapsed"])

    own = docs.select(F.col("doc_id"), F.col("text").cast("binary").alias("text"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_kept"))
    found = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    schema = T.StructType([own.schema["_kept"], *T.StructType.fromDDL(found)])
    out = own.mapInArrow(run, schema)
    return out.select("_kept.*", "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def run_report(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) and digests, from ``periodic_runs``."""
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-top["s"]).alias("start"), top["n"].alias("length"), (-top["p"]).alias("period"),
        F.floor(1000 * top["n"] / -top["p"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def plant_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by the id's CRC-32, with their words from some place on repeated in a period; null ids: none."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
