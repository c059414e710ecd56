"""SimHash near-duplicates by a hierarchical index in Gray order.

Fingerprints are sorted by Gray rank, in which neighbours differ in few bits, also across the borders of a prefix. Each
run of neighbours is a node that holds the bits which all of it share (a mask and a pattern), and runs of nodes are
nodes again, up to a root. A search goes down from the root, adds up the differing bits of each level (only those bits
that the level above hasn't counted), and drops a whole group as soon as more than the limit differ.

On Spark, distinct fingerprints are cut into ranges of Gray rank of about equal counts (shards). The shards' masks and
patterns are the upper nodes: a bounded table that every task gets. A fingerprint goes to the shards that it may reach,
of each pair of shards in one direction only. A shard's task builds the lower nodes and looks up its own and the
visiting fingerprints. Fingerprints known to be connected aren't compared again: neighbours in Gray order are linked
first, and a node that lies in one component is dropped for a fingerprint of that component, so a large group of near
copies doesn't give all its pairs. Tasks return a tree of links per component that they see; the components of these are
those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolake.llm.common import bounded_rows, materialize, ship
from hydrolake.llm.jaccard_join import connected

SEED = 42
FANOUT = 16  # children of a node
SHARD = 65_536  # fingerprints in a shard, unless that gives more than SHARDS; visits grow with the cube of the shards' logarithm
SHARDS = 1 << 15  # shards at most: a table of 24 bytes each
TOGETHER = 2048  # fingerprints looked up at a time, after which components are known better
QUEUE = 16_384  # visitors that a shard gathers before it looks them up
FRONTIER = 1 << 20  # (fingerprint, node) pairs held at a time
SLICE = 1 << 16  # shingle hashes whose bits are counted at a time

EDGES = "a long, b long"


def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def shingle_hashes(text: bytes, size: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of each word shingle, repeats included; with fewer words, of the whole sequence; without, none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    k = min(size, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    return np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=False)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; no hashes: 0."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        counts += np.unpackbits(hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist()))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence: the exclusive or of the code and all its right shifts."""
    out = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        out = out ^ (out >> np.uint64(shift))
    return out


def merge(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Component labels (the smallest place in each) after joining u[i] with v[i] for all i."""
    while True:
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            return labels
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        root = np.arange(len(labels))
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further
        labels = root[labels]


class GrayIndex:
    """The hierarchical index over leaves (a mask of fixed bits and their pattern) that are sorted by Gray rank."""

    def __init__(self, masks: np.ndarray, patterns: np.ndarray) -> None:
        self.levels = [(masks, patterns)]  # leaves first
        while len(self.levels[-1][0]) > 1:
            masks, patterns = self.levels[-1]
            at = np.arange(0, len(masks), FANOUT)
            every, some = np.bitwise_and.reduceat(patterns, at), np.bitwise_or.reduceat(patterns, at)
            shared = np.bitwise_and.reduceat(masks, at) & ~(every ^ some)
            self.levels.append((shared, every & shared))

    def labelled(self, labels: np.ndarray) -> list[np.ndarray]:
        """For each level and node the one label of all its leaves, or -1."""
        low = high = labels
        out = [labels]
        for masks, _ in self.levels[1:]:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            assert len(low) == len(masks)
            out.append(np.where(low == high, low, -1))
        return out

    def search(self, codes: np.ndarray, limit: int, labels: np.ndarray | None = None, own: list[np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in codes, leaf) arrays of all that differ in ``limit`` fixed bits at most.

        With ``labels`` (of the codes) and ``own`` (of the nodes), nodes that lie in the code's own component are left out.
        """
        n, top = len(codes), len(self.levels) - 1
        if not n or not len(self.levels[0][0]):
            return
        todo = [(top, np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.uint8), np.zeros(n, np.uint64))]
        while todo:
            level, q, node, apart, counted = todo.pop()
            masks, patterns = self.levels[level]
            mask = masks[node]
            apart = apart + np.bitwise_count((codes[q] ^ patterns[node]) & (mask & ~counted))
            near = apart <= limit
            if labels is not None:
                near &= own[level][node] != labels[q]
            q, node, apart, mask = q[near], node[near], apart[near], mask[near]
            if not level:
                if len(q):
                    yield q, node
                continue
            below = len(self.levels[level - 1][0])
            for at in range(0, len(q), FRONTIER // FANOUT):
                part = slice(at, at + FRONTIER // FANOUT)
                child = (node[part, None] * FANOUT + np.arange(FANOUT)).ravel()
                there = child < below
                todo.append((level - 1, *(np.repeat(x[part], FANOUT)[there] if x is not node else child[there] for x in (q, node, apart, mask))))


def neighbours(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbours in Gray order within the limit, for the codes as they are and turned by 16, 32 and 48 bits."""
    u, v = [], []
    for turn in (0, 16, 32, 48):
        turned = (codes << np.uint64(turn)) | (codes >> np.uint64(64 - turn)) if turn else codes
        order = np.argsort(gray_rank(turned), kind="stable")
        for step in (1, 2):
            a, b = order[:-step], order[step:]
            near = np.bitwise_count(codes[a] ^ codes[b]) <= limit
            u.append(a[near])
            v.append(b[near])
    return np.concatenate(u), np.concatenate(v)


class Shard:
    """The members of a shard, what connects them, and look-ups of visitors.

    members: distinct, sorted by Gray rank.
    """

    def __init__(self, members: np.ndarray, limit: int) -> None:
        self.members, self.limit = members, limit
        self.index = GrayIndex(np.full(len(members), ~np.uint64(0)), members)
        self.labels = self._look_up(members, 0, merge(np.arange(len(members)), *neighbours(members, limit)))

    def _look_up(self, codes: np.ndarray, first: int, labels: np.ndarray) -> np.ndarray:
        """Labels of the members and the codes (nodes from ``first`` on) after looking up the codes."""
        for at in range(0, len(codes), TOGETHER):
            part = slice(at, min(at + TOGETHER, len(codes)))
            own = self.index.labelled(labels[: len(self.members)])
            for q, leaf in self.index.search(codes[part], self.limit, labels[first + at : first + part.stop], own):
                labels = merge(labels, q + at + first, leaf)
        return labels

    def visit(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A link (code, member) for each visitor that is connected with a member."""
        m = len(self.members)
        now = merge(np.concatenate([self.labels, m + np.arange(len(codes))]), *neighbours(np.concatenate([self.members, codes]), self.limit))
        now = self._look_up(codes, m, now)
        self.labels = now[:m]
        found = now[m:] < m  # components without a member are other shards' matter
        return codes[found], self.members[now[m:][found]]

    def rest(self) -> tuple[np.ndarray, np.ndarray]:
        """A link for each member that isn't the first of its component."""
        apart = self.labels != np.arange(len(self.members))
        return self.members[apart], self.members[self.labels[apart]]


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a signed number) per row; null text counts as empty."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t.as_py() or b"", size)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


def ranked(prints: DataFrame) -> DataFrame:
    """``prints`` with rank: the Gray rank, moved so that signed numbers sort like unsigned ones."""
    rank = F.col("fp")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return prints.withColumn("rank", rank.bitwiseXOR(F.lit(-(1 << 63)).cast("long")))


def sharded(prints: DataFrame, shard_size: int) -> DataFrame:
    """fp, rank, shard: ranges of Gray rank with about equal counts; equal inputs give equal shards."""
    rows = ranked(prints)
    shards = max(1, min(SHARDS, -(-rows.count() // shard_size)))
    at = [i / shards for i in range(1, shards)]
    cuts = sorted(set(rows.agg(F.percentile_approx("rank", at, 10 * shards).alias("cuts")).first()["cuts"] or [])) if at else []
    limits = np.array(cuts, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = np.searchsorted(limits, batch.column(1).to_numpy(zero_copy_only=False), side="left")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(where.astype(np.int32))], names=["fp", "rank", "shard"])

    return rows.select("fp", "rank").mapInArrow(run, "fp long, rank long, shard int")


def near_links(prints: DataFrame, limit: int = 3, shard_size: int = SHARD) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of all links of ``limit`` bits or fewer."""
    spark = prints.sparkSession
    rows = materialize(sharded(prints, shard_size).select("fp", "rank", "shard"), "sharded")
    every, some = F.bit_and("fp").alias("every"), F.bit_or("fp").alias("some")
    known = sorted(bounded_rows(rows.groupBy("shard").agg(every, some), SHARDS, "shards"), key=lambda r: r["shard"])
    shards = np.array([r["shard"] for r in known], np.int64)
    all_of, any_of = (np.array([r[c] for r in known], np.int64).view(np.uint64) for c in ("every", "some"))
    masks = ~(all_of ^ any_of)
    upper = spark.sparkContext.broadcast((shards, masks, all_of & masks))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, masks, patterns = upper.value
        index = GrayIndex(masks, patterns)
        for batch in batches:
            codes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rank, home = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for q, leaf in index.search(codes, limit):
                to, own = shards[leaf], home[q]
                goes = (to == own) | (((to + own) % 2 == 0) == (own < to))  # of two shards, one visits the other
                q, to = q[goes], to[goes]
                yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), pa.array(to != home[q]), pa.array(rank[q]), pa.array(codes[q].view(np.int64))], names=["shard", "visits", "rank", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard, members, queue = None, None, [], []

        def visits() -> Iterator[pa.RecordBatch]:
            nonlocal shard, members, queue
            shard = shard or Shard(np.concatenate(members), limit)
            if queue:
                yield edges(*shard.visit(np.concatenate(queue)))
            queue = []

        for batch in batches:
            own, visiting, codes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3))
            for part in np.split(np.arange(len(own)), np.flatnonzero(np.diff(own)) + 1):
                if own[part[0]] != number:
                    if number is not None:
                        yield from visits()
                        yield edges(*shard.rest())
                    number, shard, members, queue = own[part[0]], None, [], []
                flag, code = visiting[part], codes[part].view(np.uint64)
                members.append(code[~flag])
                queue += [code[flag]] if flag.any() else []
                if sum(map(len, queue)) >= QUEUE:
                    yield from visits()
        if number is not None:
            yield from visits()
            yield edges(*shard.rest())

    routed = rows.mapInArrow(route, "shard int, visits boolean, rank long, fp long")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(known))
    dealt = routed.repartition(parts, "shard").sortWithinPartitions("shard", "visits", "rank")
    return dealt.mapInArrow(link, EDGES)


def near_duplicates(docs: DataFrame, limit: int = 3, size: int = 3, shard_size: int = SHARD) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id per row of ``docs``.

    Rows link if their fingerprints differ in ``limit`` bits or fewer; component_id is the smallest doc_id reachable. Null
    or empty texts and those without words have the fingerprint 0 and link like others. Null ids take part and get the
    smallest id of their component, null if it has none. Repeated rows have equal fingerprints. Other columns are ignored.
    """
    rows = materialize(fingerprints(docs, size), "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    links = materialize(near_links(prints.select("fp"), limit, shard_size).distinct(), "near")
    roots = connected(links)
    placed = prints.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    whole = placed.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(whole, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
