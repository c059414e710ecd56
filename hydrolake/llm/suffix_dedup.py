"""Removal of repeated byte strings by difference-cover blockwise suffix sorting.

A byte goes if a window of ``size`` bytes over it also starts in a document with a smaller id, so what counts is which
suffixes have a common prefix of ``size`` bytes or more.

1. packs    documents are packed, a few MB of text each, compressed, and written as a table bucketed by pack, so that
            replies are joined to packs where they lie: texts aren't shuffled again.
2. anchors  in each window, the k-gram of the least hash is its anchor; equal windows have equal anchors at equal places.
            Packs send the hashes of their anchors to buckets; those in one place only can't be in a repeat.
3. sorting  packs send the strings around the anchors that are left, once per pack, to the anchors' buckets. A bucket is
            a text of its own that holds all equal windows of the corpus. Its suffixes are sorted blockwise:
            ranks of a difference-cover sample are computed once, by doubling; sampled splitters part the suffixes by
            their leading bytes into blocks; one block at a time is sorted by the bytes of one period, and longer ties
            are resolved by the ranks of the two sample places that lie at one distance from both suffixes. Neighbours
            with a common prefix of ``size`` bytes are equal windows.
4. answer   the least document of each window goes back to its pack, where the bytes are removed.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolake.llm.common import drop_finished_shuffles, materialize, materialize_bucketed, remove_table, table_buckets, whole_text

PACK_BYTES = 2 << 20
PART_BYTES = 16 << 20  # text in one bucket of the table of packs, about
SEGMENT = 1 << 19  # windows looked at together
BLOCK = 1 << 19  # suffixes of a bucket sorted together, about
TEXT_BYTES = 24 << 20  # a bucket with more text is parted by its anchors
#: Difference covers by period; any distance is the difference of two members, modulo the period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
NO_ID = np.iinfo(np.int64).max  # null doc_id: after all others
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _u64(x: int) -> np.uint64:
    return np.uint64(x)


def gram_bytes(size: int) -> int:
    """Bytes of an anchor."""
    return 20 if size >= 40 else max(1, size // 2)


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all k-grams, from their words of 8, 4 or 1 bytes (the last one may overlap the one before)."""
    words, step = b.astype(np.uint64), 1
    while step < 8 and 2 * step <= k:
        words = words[:-step] | words[step:] << _u64(8 * step)
        step *= 2
    n = max(0, len(b) - k + 1)
    h = np.zeros(n, np.uint64)
    for i, at in enumerate([*range(0, k - step, step), k - step]):
        h = (h ^ words[at : at + n]) * _u64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[i % 3])
        h ^= h >> _u64(32 - i % 3)
    return h


def window_runs(b: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first start, end (exclusive), anchor's place, anchor's hash (48 bits).

    ``b`` holds texts that end at ``ends``; windows over an end aren't windows.
    """
    parts = []
    k = gram_bytes(size)
    w = size - k + 1
    left = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(b))  # bytes from here to the text's end
    for s in range(0, len(b) - size + 1, SEGMENT):
        own = b[s : s + SEGMENT + size - 1]
        h = gram_hashes(own, k)
        low = _u64((1 << 24) - 1)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # leftmost of equal hashes
        span = 1
        while 2 * span <= w:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: len(h) - w + 1], least[w - span : len(h) - span + 1])
        at = (least & low).astype(np.int64)
        valid = left[s : s + len(at)] >= size
        before = np.r_[False, valid[:-1]]
        first = np.flatnonzero(valid & (~before | np.r_[True, at[1:] != at[:-1]]))
        stops = np.r_[np.flatnonzero(before & ~valid), len(at)]
        end = np.minimum(np.r_[first[1:], len(at)], stops[np.searchsorted(stops, first, "right")]) if len(first) else first
        parts.append((first + s, end + s, at[first] + s, h[at[first]] >> _u64(16)))
    if not parts:
        e = np.empty(0, np.int64)
        return e, e, e, np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def one_by_one(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch, only one of them as Python values at a time."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def pack_up(ids: list, raws: list[bytes]) -> bytes:
    head = np.array([len(ids)], "<i8").tobytes() + np.array([NO_ID if i is None else i for i in ids], "<i8").tobytes() + np.array([len(r) for r in raws], "<i8").tobytes()
    return zstandard.compress(head + b"".join(raws), 3)


def unpack(z: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, ends of texts, all bytes."""
    raw = zstandard.decompress(z)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ids, lens = np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, "<i8", n, 8 + 8 * n)
    return ids, np.r_[0, np.cumsum(lens)], np.frombuffer(raw, np.uint8, offset=8 + 16 * n)


class PackRuns:
    """All runs of a pack: document's number, start, end, anchor, hash (places within the pack)."""

    def __init__(self, z: bytes, size: int):
        self.ids, self.ends, self.raw = unpack(z)
        self.start, self.end, self.anchor, self.hash = window_runs(self.raw, self.ends, size)
        self.doc = np.searchsorted(self.ends, self.start, "right") - 1

    def strings(self, shared: np.ndarray, size: int) -> tuple[np.ndarray, list[bytes], np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """Of runs with a shared anchor: their numbers, then the distinct records (two bytes for the anchor's offset, and
        the text), their anchors' hashes, each run's record and each record's least document."""
        if not len(shared):
            which = np.empty(0, np.int64)
        else:
            at = np.minimum(np.searchsorted(shared, self.hash), len(shared) - 1)
            which = np.flatnonzero(shared[at] == self.hash)
        first, last, offset = self.start[which], self.end[which] - 1 + size, self.anchor[which] - self.start[which]
        known: dict[bytes, int] = {}
        of = np.empty(len(which), np.int64)
        whole = self.raw.tobytes()
        head = [i.to_bytes(2, "little") for i in range(size)]
        for i, (a, b, c) in enumerate(zip(first.tolist(), last.tolist(), offset.tolist(), strict=True)):
            of[i] = known.setdefault(head[c] + whole[a:b], len(known))
        hashes = np.zeros(len(known), np.uint64)
        hashes[of] = self.hash[which]
        least = np.full(len(known), NO_ID, np.int64)
        np.minimum.at(least, of, self.ids[self.doc[which]])
        return which, list(known), hashes, (of, least)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes % _u64(buckets)).astype(np.int64)


def to_bytes(hashes: np.ndarray) -> bytes:
    """Six bytes each."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_bytes(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def period_of(size: int) -> int:
    """The largest period of a known cover that is at most half of ``size``."""
    return max(v for v in COVERS if v == 1 or 2 * v <= size)


def shift_table(v: int) -> np.ndarray:
    """For two residues, the least distance that takes both into the cover."""
    inside = np.isin(np.arange(2 * v) % v, COVERS[v])
    return np.array([[next(s for s in range(v) if inside[a + s] and inside[b + s]) for b in range(v)] for a in range(v)], np.int64)


def dense(keys: np.ndarray) -> np.ndarray:
    """Ranks from 0; equal keys have equal ranks."""
    order = np.argsort(keys)
    s = keys[order]
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(np.r_[False, s[1:] != s[:-1]][: len(s)]).astype(np.uint64)
    return out


class SuffixBlocks:
    """A text of many strings, each padded with zeros, and the ranks of its difference-cover sample."""

    def __init__(self, texts: list[bytes], size: int):
        self.size, self.v = size, period_of(size)
        self.lens = np.fromiter(map(len, texts), np.int64, len(texts))
        room = self.lens + self.v + 8
        self.base = np.cumsum(room) - room
        buf = np.zeros(int(room.sum()) + 8, np.uint8)
        pad = bytes(self.v + 8)
        joined = pad.join(texts) + pad
        buf[: len(joined)] = np.frombuffer(joined, np.uint8)
        self.words = np.ndarray((len(buf) - 7,), ">u8", buf, 0, (1,))  # the eight bytes from each place on
        self.shifts = shift_table(self.v)
        inside = np.zeros(len(buf), bool)
        inside[: len(joined)] = np.isin(np.arange(self.v), COVERS[self.v])[np.arange(len(joined)) % self.v]
        sample = np.flatnonzero(inside)
        of = np.searchsorted(self.base, sample, "right") - 1
        end = (self.base + self.lens)[of]
        sample, end = sample[sample < end], end[sample < end]
        self.rank = np.zeros(len(buf), np.uint32)  # 0: no sample, or past a string's end
        ranks = dense(self.bytes_at(sample, 0, min(8, self.v)))
        for at, n in self.after_eight():
            ranks = dense(ranks << _u64(8 * n) | self.bytes_at(sample, at, n))
        known, longest = self.v, int(self.lens.max(initial=0))
        while True:
            self.rank[sample] = ranks + _u64(1)
            if known >= longest:
                break
            then = np.where(sample + known < end, self.rank[np.minimum(sample + known, len(buf) - 1)], 0)
            ranks = dense(ranks << _u64(32) | then.astype(np.uint64))
            known *= 2

    def bytes_at(self, places: np.ndarray, at: int, n: int) -> np.ndarray:
        return self.words[places + at].astype(np.uint64) >> _u64(64 - 8 * n)

    def after_eight(self) -> list[tuple[int, int]]:
        """The bytes of a period after the first eight, as many at a time as fit beside a rank."""
        return [(at, min(4, self.v - at)) for at in range(8, self.v, 4)]

    def sort_block(self, places: np.ndarray, leading: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of the suffixes at ``places``, and where in it a group with ``size`` equal bytes begins."""
        order = np.argsort(leading)
        s = leading[order]
        group = np.cumsum(np.r_[False, s[1:] != s[:-1]]).astype(np.uint64)
        for at, n in self.after_eight():
            key = group << _u64(8 * n) | self.bytes_at(places[order], at, n)
            again = np.argsort(key)
            order, s = order[again], key[again]
            group = np.cumsum(np.r_[False, s[1:] != s[:-1]]).astype(np.uint64)
        self._resolve_ties(places, order, group)
        p = places[order]
        new = np.r_[True, group[1:] != group[:-1]]
        for at in range(self.v, self.size, 8):
            word = self.bytes_at(p, at, min(8, self.size - at))
            new[1:] |= word[1:] != word[:-1]
        return order, new

    def _resolve_ties(self, places: np.ndarray, order: np.ndarray, group: np.ndarray) -> None:
        """Sort, in ``order``, the members of each group of suffixes that are equal over a period.

        All groups at once: each is parted in three by the ranks of a pivot and its members, compared at the distance
        that takes both into the sample, until nothing is left but suffixes that are equal to their ends.
        """
        slots = np.arange(len(order))
        while True:
            first = np.r_[True, group[1:] != group[:-1]][: len(group)]
            starts = np.flatnonzero(first)
            sizes = np.diff(np.r_[starts, len(group)])
            if not (sizes > 1).any():
                return
            many = np.repeat(sizes > 1, sizes)
            slots, group = slots[many], group[many]
            starts, sizes = np.cumsum(sizes[sizes > 1]) - sizes[sizes > 1], sizes[sizes > 1]
            p = places[order[slots]]
            pivot = np.repeat(p[starts + sizes // 2], sizes)
            shift = self.shifts[p % self.v, pivot % self.v]
            own, other = self.rank[p + shift], self.rank[pivot + shift]
            side = (own >= other).astype(np.uint64) + (own > other)
            number = np.repeat(np.arange(len(starts), dtype=np.uint64), sizes)
            key = number * _u64(3) + side
            again = np.argsort(key, kind="stable")
            order[slots] = order[slots][again]
            key = key[again]
            left = key % _u64(3) != 1  # equal to the pivot: done
            slots, group = slots[left], key[left]


def least_documents(texts: list[bytes], docs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every string (in order): the least document with that window; and each string's first window."""
    blocks = SuffixBlocks(texts, size)
    n_windows = blocks.lens - size + 1
    at = np.cumsum(n_windows) - n_windows
    string = np.repeat(np.arange(len(texts)), n_windows)
    places = blocks.base[string] + np.arange(len(string)) - at[string]
    leading = blocks.bytes_at(places, 0, min(8, blocks.v))
    parts = -(-len(places) // BLOCK)
    if parts > 1:
        sample = np.sort(leading[:: max(1, len(leading) // (256 * parts))])
        splitters = np.unique(sample[np.arange(1, parts) * len(sample) // parts])
        part = np.searchsorted(splitters, leading, "right")
        by_part = np.argsort(part, kind="stable")
        members = np.split(by_part, np.searchsorted(part[by_part], np.arange(1, len(splitters) + 1)))
    else:
        members = [np.arange(len(places))]
    least = np.empty(len(places), np.int64)
    for own in members:
        if not len(own):
            continue
        order, new = blocks.sort_block(places[own], leading[own])
        own = own[order]
        starts = np.flatnonzero(new)
        least[own] = np.repeat(np.minimum.reduceat(docs[string[own]], starts), np.diff(np.r_[starts, len(own)]))
    return least, at


def remove_repeats(docs: DataFrame, size: int = 50, bucket_bytes: int = 6 << 20) -> DataFrame:
    """RESULT per row: bytes, removed bytes and runs, and the SHA-256 of what is kept, for windows of ``size`` bytes.

    1 <= size < 65536. doc_id must be an integer or null. Null text counts as empty. Rows with equal ids never remove
    each other's bytes; null ids count as after all others. Extra columns are ignored. A bucket holds about
    ``bucket_bytes`` of the corpus; a string common to many documents is sent once per pack and kept once per bucket.
    """
    if not 1 <= size < 1 << 16:
        raise ValueError("size must be 1 to 65535")
    gram = gram_bytes(size)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        raws: list[bytes] = []
        n = 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().bytes], pa.binary()), pa.array([n], pa.int64()), pa.array([pack_up(ids, raws)], pa.binary())], names=["pack", "n", "data"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                raws.append(t.encode("utf-8", "surrogatepass"))
                n += len(raws[-1])
                if n >= PACK_BYTES:
                    yield done()
                    ids, raws, n = [], [], 0
        if ids:
            yield done()

    made = materialize(docs.select(F.col("doc_id").cast("long"), whole_text()).mapInArrow(make, "pack binary, n long, data binary"), "made-packs")
    text_bytes = made.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-text_bytes // bucket_bytes))
    parts = table_buckets(docs.sparkSession, text_bytes, PART_BYTES)
    packs = materialize_bucketed(made.select("pack", "data"), "packs", "pack", parts)
    remove_table(made)
    drop_finished_shuffles(docs.sparkSession)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, z in one_by_one(batch):
                runs = PackRuns(z, size)
                # twice within the pack: in two documents, so shared already
                own, times = np.unique(_distinct_pairs(runs.hash, runs.doc), return_counts=True)
                to = bucket_of(own, buckets)
                order = np.argsort(to, kind="stable")
                own, times, to = own[order], times[order], to[order]
                cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.empty(0, np.int64)
                if len(cuts):
                    ends = np.r_[cuts[1:], len(to)]
                    data = [to_bytes(own[a:b]) + np.packbits(times[a:b] > 1).tobytes() for a, b in zip(cuts, ends, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(to[cuts], pa.int64()), pa.array([pack] * len(cuts), pa.binary()), pa.array(data, pa.binary())], names=["bucket", "pack", "data"])

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
        """One bucket at a time from rows sorted by bucket."""
        now, names, rows = None, [], []
        for batch in batches:
            for bucket, pack, data in one_by_one(batch):
                if bucket != now and rows:
                    yield now, names, rows
                    names, rows = [], []
                now = bucket
                names.append(pack)
                rows.append(data)
        if rows:
            yield now, names, rows

    def shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, names, rows in by_bucket(batches):
            sizes = [len(r) * 8 // 49 for r in rows]  # six bytes and a bit each
            hashes = [from_bytes(r[: 6 * n]) for r, n in zip(rows, sizes, strict=True)]
            flags = [np.unpackbits(np.frombuffer(r, np.uint8, offset=6 * n), count=n) for r, n in zip(rows, sizes, strict=True)]
            every, inverse, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            times[inverse[np.concatenate(flags) > 0]] = 2
            many = times[inverse] > 1
            at, data = 0, []
            for h in hashes:
                data.append(to_bytes(h[many[at : at + len(h)]]))
                at += len(h)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(data, pa.binary())], names=["pack", "data"])

    def strings_of(data: bytes, known: list[bytes] | None) -> tuple:
        runs = PackRuns(data, size)
        shared = np.sort(from_bytes(b"".join(known or [])))
        return runs, *runs.strings(shared, size)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, text, known in (row for batch in batches for row in one_by_one(batch)):
            _, _, records, hashes, (_, least) = strings_of(text, known)
            to = bucket_of(hashes, buckets)
            order = np.argsort(to, kind="stable")
            for bucket in np.unique(to).tolist():
                number = order[np.searchsorted(to[order], bucket) : np.searchsorted(to[order], bucket, "right")]
                mine = [records[i] for i in number.tolist()]
                lens = np.fromiter(map(len, mine), np.int64, len(mine))
                head = np.array([len(mine)], "<i8").tobytes() + b"".join(x.astype("<i8").tobytes() for x in (number, least[number], lens))
                data = zstandard.compress(head + b"".join(mine), 3)
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([pack], pa.binary()), pa.array([data], pa.binary())], names=["bucket", "pack", "data"])

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, names, rows in by_bucket(batches):
            known: dict[bytes, int] = {}  # equal records of several packs are one
            told = []
            for z in rows:
                raw = zstandard.decompress(z)
                n = int(np.frombuffer(raw, "<i8", 1)[0])
                number, least, lens = np.frombuffer(raw, "<i8", 3 * n, 8).reshape(3, n)
                ends = np.cumsum(lens) + 8 + 24 * n
                of = np.fromiter((known.setdefault(raw[e - k : e], len(known)) for e, k in zip(ends.tolist(), lens.tolist(), strict=True)), np.int64, n)
                told.append((number, least, of))
            records = list(known)
            del known
            docs = np.full(len(records), NO_ID, np.int64)
            for _, least, of in told:
                np.minimum.at(docs, of, least)
            n_windows = np.fromiter(map(len, records), np.int64, len(records)) - 2 - size + 1
            at = np.cumsum(n_windows) - n_windows
            best = np.empty(int(n_windows.sum()), np.int64)
            parts = -(-sum(map(len, records)) // TEXT_BYTES)
            part = np.zeros(len(records), np.int64)
            if parts > 1:  # equal windows have equal anchors
                part = np.array([zlib.crc32(r[2 + int.from_bytes(r[:2], "little") :][:gram]) % parts for r in records])
            for i in range(parts):
                mine = np.flatnonzero(part == i)
                if len(mine):
                    found, first = least_documents([records[k][2:] for k in mine.tolist()], docs[mine], size)
                    n = n_windows[mine]
                    best[np.repeat(at[mine] - first, n) + np.arange(len(found))] = found
            for name, (number, least, of) in zip(names, told, strict=True):
                n = n_windows[of]
                first = np.cumsum(n) - n
                place = np.arange(int(n.sum())) - np.repeat(first, n)
                found = best[np.repeat(at[of], n) + place]
                news = found < np.repeat(least, n)  # else the pack knows it itself
                if news.any():
                    out = np.stack([np.repeat(number, n)[news], place[news], found[news]], 1)
                    yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([zstandard.compress(np.ascontiguousarray(out.astype("<i8")).tobytes(), 3)], pa.binary())], names=["pack", "data"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, known, told in (row for batch in batches for row in one_by_one(batch)):
            runs, which, records, _, (of, least) = strings_of(text, known)
            n_windows = np.fromiter(map(len, records), np.int64, len(records)) - 2 - size + 1
            at = np.cumsum(n_windows) - n_windows
            best = np.repeat(least, n_windows)
            for z in told or []:
                number, place, doc = np.frombuffer(zstandard.decompress(z), "<i8").reshape(-1, 3).T
                best[at[number] + place] = np.minimum(best[at[number] + place], doc)
            mark = np.zeros(len(runs.raw) + 1, np.int64)
            n = n_windows[of]
            run = np.repeat(np.arange(len(which)), n)
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            gone = best[at[of[run]] + place] < runs.ids[runs.doc[which[run]]]
            start = runs.start[which][run[gone]] + place[gone]
            np.add.at(mark, start, 1)
            np.add.at(mark, start + size, -1)
            removed = np.cumsum(mark[:-1]) > 0
            rows = []
            for i, (a, b) in enumerate(zip(runs.ends[:-1].tolist(), runs.ends[1:].tolist(), strict=True)):
                r = removed[a:b]
                spans = int(r[:1].sum() + (r[1:] & ~r[:-1]).sum())
                doc = int(runs.ids[i])
                rows.append((None if doc == NO_ID else doc, b - a, int(r.sum()), spans, hashlib.sha256(runs.raw[a:b][~r].tobytes()).hexdigest()))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    def dealt(rows: DataFrame, *by: str) -> DataFrame:
        return rows.repartition(by[0]).sortWithinPartitions(*by)

    def replies(rows: DataFrame, name: str) -> DataFrame:
        """All replies to a pack in one row, partitioned as the packs are."""
        return rows.repartition(parts, "pack").groupBy("pack").agg(F.collect_list("data").alias(name)).hint("shuffle_hash")

    hashes = packs.select("pack", "data").mapInArrow(anchors, "bucket long, pack binary, data binary")
    known = materialize(dealt(hashes, "bucket").mapInArrow(shared_anchors, "pack binary, data binary"), "shared-anchors")
    drop_finished_shuffles(docs.sparkSession)
    asked = packs.join(replies(known, "known"), "pack").select("pack", "data", "known")
    strings = asked.mapInArrow(windows, "bucket long, pack binary, data binary")
    told = materialize(dealt(strings, "bucket").mapInArrow(answers, "pack binary, data binary"), "answers")
    drop_finished_shuffles(docs.sparkSession)
    return packs.join(replies(known, "known"), "pack", "left").join(replies(told, "told"), "pack", "left").select("data", "known", "told").mapInArrow(finish, RESULT)


def _distinct_pairs(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The hashes of distinct (hash, document) pairs."""
    order = np.lexsort((docs, hashes))
    h, d = hashes[order], docs[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new]
