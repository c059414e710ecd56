"""Periodic runs, spelling variants and SimHash against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hydrolake.llm import periodic_runs, queries, simhash, spelling
from tests.llm import brute

SF = "/root/testdata/sf0.001"
EDGES = [(-1, None), (-2, ""), (-3, " \n\t "), (-4, "one"), (-5, "w " * 3000), (None, "x y z x y z x y z x y z"), (-7, "ä\x0bö\x1cü é è\n" * 30), (-7, "ä\x0bö\x1cü é è\n" * 30), (-8, "Variant variants Variante varians variänt variant " * 3)]


def documents(spark, more=EDGES):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs.unionByName(spark.createDataFrame(list(more), "doc_id long, text string")).withColumns({"n": F.lit("clash"), "word": F.lit(1), "fp": F.lit(2.0), "runs": F.lit("clash"), "a.b": F.lit(0)})


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# periodic runs


def all_runs(words, least=6):
    n, out = len(words), []
    for d in range(1, n // 4 + 1):
        i = d
        while i < n:
            if words[i] != words[i - d]:
                i += 1
                continue
            start = i - d
            while i < n and words[i] == words[i - d]:
                i += 1
            own = words[start:i]
            if len(own) >= max(least, 4 * d) and not any(own[q:] == own[:-q] for q in range(1, d)):
                out.append((start, len(own), d))
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(doc_id, text):
    words = brute.WS.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = all_runs(words)
    gone = {i for s, length, d in runs for i in range(s + d, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    said = "".join(f"{s},{length},{d}\n" for s, length, d in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


RUN_COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_of_words():
    rng = random.Random(1)
    seen = 0
    for _ in range(3000):
        letters, words = rng.choice([1, 2, 2, 3, 5]), []
        for _ in range(rng.randrange(6)):
            part = [rng.randrange(letters) for _ in range(rng.randrange(1, 12))]
            words += (part * rng.randrange(1, 8))[: rng.randrange(1, 60)]
            words = (words * rng.choice([1, 1, 1, 2, 5]))[:150]
        want = all_runs(words)
        seen += len(want)
        assert periodic_runs.find_runs(words) == want
    assert seen > 2000


def test_long_texts_with_frequent_words():
    """Many earlier occurrences of a word don't make many lags."""
    n = 60_000
    assert periodic_runs.find_runs(["a"] * n) == [(0, n, 1)]
    assert periodic_runs.find_runs([x for i in range(n // 2) for x in ("a", i)]) == []
    period = [i % 50 for i in range(990)] + list(range(100, 110))
    assert (0, 60_000, 1000) in periodic_runs.find_runs(period * 60)


def test_runs_query(spark):
    docs = documents(spark)
    found = periodic_runs.periodic_runs(docs, prepare=periodic_runs.plant_repeats)
    assert rows_of(periodic_runs.run_report(found), RUN_COLUMNS) == sorted((run_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    whole = queries.queries()["op11_periodic_runs"](spark, SF)
    assert rows_of(whole, RUN_COLUMNS) == sorted((run_row(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), key=str)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    kept = periodic_runs.periodic_runs(docs, keep=["doc_id", "a.b", "word"])
    assert kept.columns == ["doc_id", "a.b", "word", "n_words", "runs", "collapsed"]
    assert {r.collapsed for r in kept.where("doc_id = -5").collect()} == {"w"}


# spelling variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants(docs, plant=True):
    counts = Counter()
    import re

    for doc_id, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = brute.fold(w)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if plant and doc_id is not None and h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "?" + w[i + 1 :]].add(w)
            holes[w[:i] + w[i + 1 :]].add(w)
        holes[w].add(w)
    near = defaultdict(set)
    for own in holes.values():
        for a, b in combinations(own, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()), key=str)


VARIANT_COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_variants_query(spark):
    docs = documents(spark)
    want = variants([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(spelling.group_variants(docs, prepare=spelling.plant_typos), VARIANT_COLUMNS) == want
    assert sum(r[1] is not None for r in want) > 5 and any("ä" in r[0] for r in want)
    whole = queries.queries()["op12_spelling_variants"](spark, SF)
    assert rows_of(whole, VARIANT_COLUMNS) == variants([(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    assert spelling.group_variants(docs.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [3, 4, 6])
def test_variants_of_a_dense_vocabulary(spark, parts):
    """Short alphabets, repeated letters, chains of forms, ties; a hot first half."""
    rng = random.Random(4)
    texts = []
    for k in range(400):
        base = "".join(rng.choice("ab") for _ in range(rng.randrange(6, 10)))
        texts.append(" ".join([base if k % 3 else "aabbaabb" + base] * rng.choice([1, 2, 3, 30, 400])))
    texts.append("chained " * 2000 + "chaine " * 150 + "chainee " * 12)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = variants(list(enumerate(texts)), plant=False)
    assert rows_of(spelling.group_variants(docs, parts=parts), VARIANT_COLUMNS) == want
    assert any(r[2] not in (r[0], r[1]) for r in want)


def test_near_words_share_a_signature():
    rng = random.Random(9)
    ranks = {c: k for k, c in enumerate("abcdefgh")}
    for _ in range(2000):
        a = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 14)))
        at, c = rng.randrange(len(a)), rng.choice("abcdefgh")
        b = rng.choice([a[:at] + a[at + 1 :], a[:at] + c + a[at:], a[:at] + c + a[at + 1 :]])
        assert spelling.halves(a) & spelling.halves(b)
        (x, own), (y, other) = spelling.vector(a, ranks), spelling.vector(b, ranks)
        assert (x ^ y).bit_count() <= 2 and sum(p == q for p, q in zip(own, other, strict=True)) >= 2


# SimHash


def simhash_rows(docs, limit=3):
    prints = []
    for doc_id, text in docs:
        words = brute.WS.findall(brute.fold(text or ""))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
        prints.append((doc_id, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    return placed(prints, limit)


def placed(prints, limit=3):
    distinct = sorted({f for _, f in prints})
    codes, root = np.array(distinct, np.uint64), list(range(len(distinct)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(codes)):
        for j in (np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= limit) + i + 1).tolist():
            root[find(j)] = find(i)
    least, at = {}, {f: k for k, f in enumerate(distinct)}
    for doc_id, f in prints:
        r = find(at[f])
        least[r] = min((x for x in (doc_id, least.get(r)) if x is not None), default=None)
    return sorted(((doc_id, f"{f:016x}", least[find(at[f])]) for doc_id, f in prints), key=str)


SIMHASH_COLUMNS = ["doc_id", "fingerprint", "component_id"]


def test_simhash_query(spark):
    docs = documents(spark)
    assert rows_of(simhash.near_duplicates(docs, shard_size=20), SIMHASH_COLUMNS) == simhash_rows([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    whole = queries.queries()["op13_simhash"](spark, SF)
    assert rows_of(whole, SIMHASH_COLUMNS) == simhash_rows([(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def fingerprint_family(rng, n):
    """Random codes, chains of small steps, and a dense cluster."""
    codes = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n // 20):
        code = rng.getrandbits(64)
        for _ in range(10):
            for _ in range(rng.randrange(1, 5)):
                code ^= 1 << rng.randrange(64)
            codes.append(code)
    hub = rng.getrandbits(64)
    for _ in range(n // 3):
        code = hub
        for _ in range(rng.randrange(7)):
            code ^= 1 << rng.randrange(64)
        codes.append(code)
    return codes


@pytest.mark.parametrize("shard_size,limit", [(10**6, 3), (100, 3), (37, 2), (64, 0)])
def test_links_of_fingerprints(spark, monkeypatch, shard_size, limit):
    monkeypatch.setattr(simhash, "FRONTIER", 4096)
    monkeypatch.setattr(simhash, "TOGETHER", 64)
    rng = random.Random(shard_size)
    codes = fingerprint_family(rng, 900)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    prints = spark.createDataFrame([(c,) for c in set(signed)], "fp long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.near_links(prints, limit, shard_size).collect()]
    ids = list(enumerate(codes))
    want = {f: c for _, f, c in placed(ids, limit)}
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    least = {}
    for k, c in ids:
        least.setdefault(find(c), k)
    assert {f"{c:016x}": least[find(c)] for c in codes} == want
    assert len(links) < 20 * len(set(codes))


def test_gray_index_finds_all():
    rng = random.Random(7)
    codes = np.array(sorted(set(fingerprint_family(rng, 600))), np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    assert (np.bitwise_count(simhash.gray_rank(np.arange(256, dtype=np.uint64) ^ (np.arange(256, dtype=np.uint64) >> np.uint64(1))) ^ np.arange(256, dtype=np.uint64)) == 0).all()
    index = simhash.GrayIndex(np.full(len(codes), ~np.uint64(0)), codes)
    for limit in (0, 3, 7):
        got = {(int(a), int(b)) for q, leaf in index.search(codes, limit) for a, b in zip(q, leaf, strict=True)}
        assert got == {(i, int(j)) for i in range(len(codes)) for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= limit)}
