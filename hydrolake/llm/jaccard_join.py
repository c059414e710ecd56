"""N-gram Jaccard join by grouped prefixes.

A document's set is its distinct word shingles (64-bit hashes). Documents with equal sets are one class. Shingles are
ordered by a count sketch over all documents, rare first, so two similar sets share a shingle among the first few
(their prefixes). Sets with equal prefixes and sizes are one group, postings hold groups, and filters by size and
position work on pairs of groups; only then are groups expanded and their members verified on the whole texts.

Large families of near copies don't give all pairs: in the first round each group meets only the leader of each of its
shingles (the one where the shingle stands first, which has the fewest own edits); after the components of these links
are known, the second round takes every remaining pair of groups from different components, also of a group with itself
where its sets are in several. So each link between components is found, and pairs inside a known component are never
formed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrolake.llm.common import drop_finished_shuffles, materialize, whole_text

SKETCH_BITS = (20, 24)  # buckets of the count sketch, at least and at most: a broadcast of 4 to 64 MB
BLOCK = 4096  # buckets in one row of it
WORDS_KEPT = 200_000  # word hashes remembered in a task
TOGETHER = 200  # documents whose shingles are counted together


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def _mix(acc: np.ndarray) -> np.ndarray:
    acc = (acc ^ (acc >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return acc ^ (acc >> np.uint64(29))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; with fewer words, of the whole sequence; without words, empty.

    Words are parted by ASCII white space after A-Z are lower-cased, which is what bytes.lower and bytes.split do.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    k = min(size, len(w))
    acc = np.full(len(w) - k + 1, k, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            acc = _mix(acc ^ w[j : len(w) - k + 1 + j])
    return np.unique(acc)


def sketch_bits(docs: DataFrame) -> int:
    """Four buckets a document, within SKETCH_BITS. Beyond that, shingles of less than a bucket's usual count come in
    any order, and those far above it still come last, which is what keeps postings short."""
    return min(SKETCH_BITS[1], max(SKETCH_BITS[0], docs.count().bit_length() + 2))


def count_sketch(docs: DataFrame, size: int) -> np.ndarray:
    """How often each bucket of shingles occurs, over all documents.

    Tasks add up their documents, tasks of a bucket range add up these; only the bounded sketch goes to the driver.
    """
    buckets = 1 << sketch_bits(docs)
    mask = np.uint64(buckets - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                sets = [shingle_set(t, size) for t in batch.column(0).slice(at, TOGETHER).to_pylist()]
                np.add.at(total, (np.concatenate(sets) & mask).astype(np.int64), 1)
        if total.any():
            blocks = total.reshape(-1, BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([b.astype("<u4" if b.max() < 2**32 else "<u8").tobytes() for b in blocks], pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(raw, "<u4" if len(raw) == 4 * BLOCK else "<u8").astype(np.int64)
                sums[block] = sums[block] + own if block in sums else own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "counts"])

    schema = "block int, counts binary"
    rows = docs.select(whole_text()).mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], "<i8")
    return np.minimum(out, 2**32 - 1).astype(np.uint32)


def signatures(docs: DataFrame, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """doc_id, tk (hash of the text), n, sid (set), gid (prefix and size), prefix (hashes, rare first) per document."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    mask = np.uint64(len(counts) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            ns, sids, gids, prefixes = [], [], [], []
            for text in batch.column(2).to_pylist():
                own = shingle_set(text, size)
                n = len(own)
                first = np.lexsort((own, counts[(own & mask).astype(np.int64)]))[: n - (percent * n + 99) // 100 + 1] if n else []
                prefix = own[first].view(np.int64) if n else np.empty(0, np.int64)
                ns.append(n)
                sids.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                gids.append(hashlib.blake2b(prefix.tobytes() + n.to_bytes(8, "little"), digest_size=16).digest())
                prefixes.append(prefix)
            offsets = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            arrays = [pa.array(ns, pa.int32()), pa.array(sids, pa.binary()), pa.array(gids, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["doc_id", "tk", "n", "sid", "gid", "prefix"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("tk"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, tk long, n int, sid binary, gid binary, prefix array<long>")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, size: int, percent: int, repeats: bool) -> DataFrame:
    """Those of ``pairs`` (a, b: set numbers) whose sets reach the similarity, judged on whole texts.

    Only texts of sets in a pair are moved; a text goes along with each of its pairs. ``repeats``: whether a row (id and
    text) may be in ``docs`` many times; then one of them stands for all.
    """
    wanted = pairs.select(F.col("a").alias("sno")).union(pairs.select("b")).distinct()
    where = sets.join(wanted, "sno", "left_semi").select("sno", "tk", F.col("doc").alias("_doc"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), whole_text().alias("text")).withColumn("_tk", F.xxhash64("text"))
    found = where.join(texts, (F.col("tk") == F.col("_tk")) & F.col("_doc").eqNullSafe(F.col("_id"))).select("sno", "text")
    if repeats:
        found = found.groupBy("sno").agg(F.first("text").alias("text"))
    found = materialize(found, "candidate-texts")
    both = (
        pairs.join(found.toDF("b", "_tb"), "b")
        .join(found.toDF("a", "_ta"), "a")
        .select("a", "b", "_ta", "_tb")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = lru_cache(maxsize=256)(lambda text: shingle_set(text, size))
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = sorted((tokens(ta), tokens(tb)), key=len)
                at = np.searchsorted(y, x)
                same = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(x) else 0
                keep.append(same > 0 and 100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    drop_finished_shuffles(docs.sparkSession)
    return materialize(both.mapInArrow(run, "a long, b long").distinct(), "links")


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over ``edges`` (a, b), for all nodes that have an edge.

    Large-star and small-star steps in turn, each a minimum per node joined back, until the edges stay the same. Each
    round is written to the shared folder, so lineage stays short.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(now)
    for _ in range(most_rounds):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = materialize(small.where("u <> v").distinct(), "edges")
        after = mark(now)
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
        before = after
    raise ValueError("components didn't settle")


def may_link(na, nb, pa_, pb, percent: int):
    """Size and position filter: the overlap is at most what is left from the first shared shingle on."""
    most = F.least(na - pa_, nb - pb).cast("long")
    return (100 * F.least(na, nb).cast("long") >= percent * F.greatest(na, nb).cast("long")) & (most * (100 + percent) >= percent * (na.cast("long") + nb.cast("long")))


def placed_rows(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, tk (hash of the text), n_shingles, component_id, first_tk per row of ``docs``.

    component_id and first_tk are those of the component's first row by (doc_id is null, doc_id, tk); first_tk is null
    for a row without words.
    """
    sigs = materialize(signatures(docs, size, percent, count_sketch(docs, size)), "signatures")
    full = sigs.where("n > 0")
    repeats = not full.groupBy("doc_id", "tk").count().where("count > 1").isEmpty()
    groups = materialize(
        full.select("gid", "n", "prefix").dropDuplicates(["gid"]).withColumn("gno", F.monotonically_increasing_id()), "groups"
    )
    classes = full.groupBy("sid").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("doc"), "tk")).alias("x"), F.first("gid").alias("gid"), F.first("n").alias("n"))
    sets = materialize(
        classes.join(groups.select("gid", "gno"), "gid").select("sid", F.col("x.doc").alias("doc"), F.col("x.tk").alias("tk"), "gno", "n").withColumn("sno", F.monotonically_increasing_id()), "sets"
    )
    postings = groups.select("gno", "n", F.posexplode("prefix").alias("pos", "token"))

    # round 1: each group and the leaders of its shared shingles. gno has 53 bits at most, pos saturates (a weaker filter)
    packed = F.shiftleft(F.least(F.col("pos"), F.lit(1023)).cast("long"), 53).bitwiseOR(F.col("gno"))
    leaders = materialize(postings.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.min(packed).alias("leader")).where("k > 1"), "leaders")
    low = F.lit((1 << 53) - 1)
    stars = (
        postings.join(leaders.select("token", F.col("leader").bitwiseAND(low).alias("lead"), F.shiftright("leader", 53).cast("int").alias("lpos")), "token")
        .where("lead <> gno")
        .groupBy("lead", "gno")
        .agg(F.min("pos").alias("pos"), F.min("lpos").alias("lpos"), F.first("n").alias("n"))
    )
    stars = stars.join(groups.select(F.col("gno").alias("lead"), F.col("n").alias("ln")), "lead").where(may_link(F.col("n"), F.col("ln"), F.col("pos"), F.col("lpos"), percent))
    heads = sets.groupBy("gno").agg(F.min("sno").alias("head"))
    across = stars.select("lead", "gno").join(heads.toDF("lead", "a"), "lead").join(sets.select("gno", F.col("sno").alias("b")), "gno").select("a", "b")
    within = sets.select("gno", F.col("sno").alias("b")).join(heads.withColumnRenamed("head", "a"), "gno").where("a <> b").select("a", "b")
    tried = materialize(across.union(within).distinct(), "tried")
    links = verified(tried, sets, docs, size, percent, repeats)

    drop_finished_shuffles(docs.sparkSession)

    # round 2: whatever may link two components
    roots = connected(links)
    placed = materialize(sets.select("sno", "gno", "n").join(roots.withColumnRenamed("node", "sno"), "sno", "left").withColumn("comp", F.coalesce("root", "sno")).drop("root"), "placed")
    parts = placed.select("gno", "comp").distinct()
    shared = postings.join(leaders.select("token"), "token", "left_semi").join(parts, "gno")
    # round 1 tried a group's sets with its head only: a group in several components meets itself, from place 0 on
    split = parts.groupBy("gno").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("gno")
    own = groups.join(split, "gno").select("gno", "n", F.lit(0).alias("pos"), F.xxhash64("gid").alias("token")).join(parts, "gno")
    shared = shared.unionByName(own)
    mixed = shared.groupBy("token").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("token")
    rows = materialize(shared.join(mixed, "token", "left_semi").select("token", "comp", "gno", "n", "pos"), "mixed")
    spans = materialize(rows.groupBy("token", "comp").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("pos")).alias("rest")), "spans")
    x, y = spans.toDF("token", "c1", "low1", "high1", "rest1"), spans.toDF("token", "c2", "low2", "high2", "rest2")
    met = x.join(y, "token").where("c1 < c2").where(f"100 * high1 >= {percent} * low2 and 100 * high2 >= {percent} * low1").where(
        f"least(rest1, rest2) * {100 + percent} >= {percent} * (low1 + low2)"
    ).select("token", "c1", "c2", "low2", "high2", "rest2")
    r1, r2 = rows.toDF("token", "c1", "g1", "n1", "p1"), rows.toDF("token", "c2", "g2", "n2", "p2")
    # members of c1 that can reach the other component's sizes and places at all
    able = met.join(r1, ["token", "c1"]).where(
        f"100 * n1 >= {percent} * low2 and 100 * high2 >= {percent} * n1 and least(n1 - p1, rest2) * {100 + percent} >= {percent} * (n1 + greatest(low2, {percent} * n1 / 100))"
    )
    left = (
        able.join(r2, ["token", "c2"])
        .where(may_link(F.col("n1"), F.col("n2"), F.col("p1"), F.col("p2"), percent))
        .groupBy("g1", "c1", "g2", "c2").agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.first("n1").alias("n1"), F.first("n2").alias("n2"))
        .where(may_link(F.col("n1"), F.col("n2"), F.col("p1"), F.col("p2"), percent))
    )
    m1, m2 = placed.select(F.col("gno").alias("g1"), F.col("comp").alias("c1"), F.col("sno").alias("s1")), placed.select(F.col("gno").alias("g2"), F.col("comp").alias("c2"), F.col("sno").alias("s2"))
    pairs = left.join(m1, ["g1", "c1"]).join(m2, ["g2", "c2"]).select(F.least("s1", "s2").alias("a"), F.greatest("s1", "s2").alias("b")).distinct()
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = materialize(pairs.join(known, ["a", "b"], "left_anti"), "more-pairs")
    drop_finished_shuffles(docs.sparkSession)
    if more.isEmpty():
        final = roots
    else:
        extra = verified(more, sets, docs, size, percent, repeats)
        final = roots if extra.isEmpty() else connected(links.union(extra))

    whole = sets.join(final.withColumnRenamed("node", "sno"), "sno", "left").withColumn("root", F.coalesce("root", "sno"))
    first = F.min(F.struct(F.col("doc").isNull().alias("z"), "doc", "tk")).alias("x")
    smallest = whole.groupBy("root").agg(first).select("root", F.col("x.doc").alias("component_id"), F.col("x.tk").alias("first_tk"))
    of_set = whole.select("sid", "root").join(smallest, "root").select("sid", "component_id", "first_tk")
    return (
        sigs.select("doc_id", "tk", "n", "sid").join(of_set, "sid", "left")
        .select("doc_id", "tk", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "first_tk")
    )


def jaccard_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs``: links where 100 * intersection >= percent * union.

    doc_id must be an integer or null. component_id is the smallest doc_id reachable. Null or empty text, or one without words: n_shingles 0, linked
    with nothing, its component its own doc_id. Null doc_ids take part and get the component's smallest id, null if
    there is none. Repeated rows have equal sets, so they share a component. Extra columns are ignored.
    """
    return placed_rows(docs, size, percent).select("doc_id", "n_shingles", "component_id")


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: the first by (doc_id is null, doc_id, hash of the text); all columns stay.

    Rows without words stay, all of them. Each row is judged by its own text, whatever other rows have its doc_id. Of
    rows equal in doc_id and text, one stays.
    """
    found = materialize(placed_rows(docs, size, percent).where("n_shingles > 0"), "components")
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("tk") == F.col("first_tk"))
    keys = found.select(F.col("doc_id").alias("_doc"), F.col("tk").alias("_tk"), first.alias("first"))
    gone = keys.where("not first").select("_doc", "_tk").distinct()
    again = materialize(keys.where("first").groupBy("_doc", "_tk").count().where("count > 1").select("_doc", "_tk"), "repeated")

    def same(other: DataFrame):
        return F.col("_own_doc").eqNullSafe(other["_doc"]) & (F.col("_own_tk") == other["_tk"])

    own = docs.withColumns({"_own_doc": F.col("doc_id").cast("long"), "_own_tk": F.xxhash64(whole_text())})
    kept = own.join(gone, same(gone), "left_anti")
    if not again.isEmpty():
        once = kept.join(again, same(again), "left_semi").dropDuplicates(["_own_doc", "_own_tk"])
        kept = kept.join(again, same(again), "left_anti").unionByName(once)
    return kept.select([f"`{c}`" for c in docs.columns])
