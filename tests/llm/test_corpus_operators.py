"""Quality, near copies, repeats, archives and personal data against brute force."""

import base64
import datetime
import hashlib
import ipaddress
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydrolake.llm import jaccard_join, pii, quality_pu, quality_rules, suffix_dedup, warc
from hydrolake.llm.common import fresh_path
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def documents(spark, more=()):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs.unionByName(spark.createDataFrame(list(more), "doc_id long, text string")) if more else docs


def key(row):
    return tuple((x is None, str(x)) for x in row)


EDGES = [(-1, None), (-2, ""), (-3, " \n\t "), (-4, "a b c a b c a b c\n\na b c\nx # <|>"), (-5, "one"), (-6, "w " * 3000), (None, "x y z x y z"), (-7, "ä\x0bö\x1cü é è\n" * 30)]


def test_quality_measures(spark):
    docs = documents(spark, EDGES).withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string")).withColumn("n_words", F.lit("clash"))
    judged = quality_rules.judge_quality(docs).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in judged), key=key)
    assert got == sorted(((d, *brute.quality(t)) for d, t in docs.select("doc_id", "text").collect()), key=key)
    assert not any(r.kept and r.base_failed for r in judged)
    assert quality_rules.judge_quality(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_quality_verdicts(spark, sf):
    """kept against exact quantiles; a hot source, null groups, repeated rows; the same in every run."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = docs.where("doc_id % 3 = 0").select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.when(F.col("doc_id") % 2 == 0, "hot").alias("source"))
    rows = docs.unionByName(odd).unionByName(docs.where("doc_id < 20")).unionByName(spark.createDataFrame([(None, None, "en", None), (-1, "", None, "x")], docs.schema))
    own = [tuple(r) for r in rows.select("lang", "source", "text").collect()]
    for reach, prior in ((3.0, 100), (0.7, 10)):
        want = sorted(zip([r.doc_id for r in rows.select("doc_id").collect()], brute.quality_kept(own, reach, prior), strict=True), key=key)
        runs = [sorted(((r.doc_id, r.kept) for r in quality_rules.judge_quality(d, reach=reach, prior_rows=prior).collect()), key=key) for d in (rows, rows.repartition(7))]
        assert runs[0] == want and runs[1] == want
    fences = brute.quality_fences(own, 3.0, 100)
    assert len({f[3] for f in fences.values()}) > len(fences) / 2


def test_bad_groups_lose_more(spark):
    """A clean group loses nothing, one with a share of junk that share, and one of junk alone isn't its own measure."""
    rng = random.Random(12)
    good = lambda: " ".join("".join(rng.choice("aeiourstln") for _ in range(rng.randrange(3, 8))) for _ in range(200))
    junk = lambda: " ".join(rng.choice(["##", "$$$", "buy%now", "<b>", "||", "word"]) + str(rng.randrange(10**6)) for _ in range(200))
    rows = [(0, good(), "en", "clean") for _ in range(300)] + [(1 if k % 6 == 0 else 0, junk() if k % 6 == 0 else good(), "en", "mixed") for k in range(300)] + [(1, junk(), "en", "junk") for _ in range(60)]
    docs = spark.createDataFrame([(k, bad, text, lang, source) for k, (bad, text, lang, source) in enumerate(rows)], "doc_id long, bad int, text string, lang string, source string")
    judged = quality_rules.judge_quality(docs, keep=["doc_id", "bad", "source"]).groupBy("source", "bad").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {(r.source, r.bad): r.kept for r in judged}
    assert kept["clean", 0] > 0.99 and kept["mixed", 0] > 0.98 and kept["mixed", 1] < 0.02 and kept["junk", 1] < 0.02


def test_more_bad_text_is_lost_than_good(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality_rules.judge_quality(spark.read.parquet(f"{sf}/documents.parquet")).where("NOT base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    lost = {r.quality: r.lost for r in judged.groupBy("quality").agg(F.avg((~F.col("kept")).cast("int")).alias("lost")).collect()}
    assert lost[1] < 0.02 and lost[0] > 20 * lost[1] and lost[0] > 0.5


def test_repeats_when_hashes_clash(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "LOW", (1 << 3) - 1)
    monkeypatch.setattr(quality_rules, "POSITION_BITS", 3)
    docs = documents(spark, EDGES)
    got = sorted(((r.doc_id, r.n_repeat_words) for r in quality_rules.text_measures(docs, ["doc_id"]).collect()), key=key)
    assert got == sorted(((d, brute.quality(t)[4]) for d, t in docs.collect()), key=key)


def test_quality_classifier(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_pu.score_quality(docs, labels, n_positive=1000, n_unlabelled=1500).join(labels, "doc_id").where("held_out and quality is not null").collect()
    right = np.mean([r.predicted == r.quality for r in rows])
    assert len(rows) > 30 and right >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (None, "a b", "c"), (3, "x " * 50000, "c"), (3, "y", "c")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    rows = quality_pu.score_quality(docs, labels).collect()
    assert len(rows) == 5 and {r.score for r in rows} == {0.5}
    assert quality_pu.score_quality(docs.limit(0), labels).count() == 0


def test_prior_is_recovered():
    rng = np.random.default_rng(5)
    good, bad = rng.normal(1, 0.5, (4000, 3)), rng.normal(-1, 0.5, (4000, 3))
    unlabelled = np.vstack([good[:2800], bad[:1200]])
    model, prior = quality_pu.fit_pu(good[2800:], unlabelled, steps=1500)
    assert abs(prior - 0.7) < 0.08
    assert (model.score(good) >= 0.5).mean() > 0.95 and (model.score(bad) < 0.5).mean() > 0.95


def family(rng, n, words, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_jaccard_components(spark, size, percent):
    rng = random.Random(3)
    texts = [t for n, w, e in ((40, 120, 8), (25, 300, 14), (10, 8, 1), (6, 3, 1)) for t in family(rng, n, w, e)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 40))) for _ in range(30)]
    texts += [texts[3]] * 5 + ["A b C", "a B c", "a b", None, "", " \n"]
    rng.shuffle(texts)
    rows = [(i + 1000, t) for i, t in enumerate(texts)]
    docs = documents(spark, rows)
    want = sorted((d, *x) for d, x in brute.components([tuple(r) for r in docs.collect()], size, percent).items())
    got = sorted(map(tuple, jaccard_join.jaccard_components(docs.withColumn("n", F.lit(1)), size, percent).collect()))
    assert got == want


def test_jaccard_edges(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "x y z x y z"), (7, "other words here now then"), (None, None), (9, "A B C D E F")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sid", F.lit("clash"))
    got = sorted(map(tuple, jaccard_join.jaccard_components(docs, 4, 85).collect()), key=key)
    assert got == sorted([(5, 3, 5), (5, 3, 5), (None, 3, 5), (7, 3, 7), (7, 2, 7), (None, 0, None), (9, 3, 5)], key=key)
    assert jaccard_join.jaccard_components(docs.limit(0), 4, 85).count() == 0
    kept = jaccard_join.deduplicate(docs.where("doc_id is null or doc_id <> 7"), 4, 85)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.where("doc_id is not null").collect())) == [5]


def test_jaccard_many_equal_rows(spark):
    """Pairs are of sets: a row that comes many times is compared once."""
    near = " ".join(f"k{i}" for i in range(40))
    docs = spark.createDataFrame([(1, near), (2, near + " k40")], "doc_id long, text string").join(spark.range(300).select(F.lit(1).alias("one")))
    found = jaccard_join.jaccard_components(docs, 4, 85)
    assert {tuple(r) for r in found.collect()} == {(1, 37, 1), (2, 38, 1)} and found.count() == 600


def test_jaccard_links_inside_a_prefix_group(spark):
    """In a group (five rare words, ten in all) only two sets are alike; whichever is tried first, they must meet.

    In every second group the last rare word also stands in a text outside it.
    """
    texts = [" ".join(f"{c}{i}" for c in "abcde" for i in range(9))] * 80
    for g in range(24):
        rare = " ".join(f"r{g}x{i}" for i in range(5))
        texts += [f"{rare} a0 a1 a2 a3 a4", f"{rare} c0 c1 c2 c3 c4", f"{rare} b0 b1 b2 b3 b4", f"{rare} b0 b1 b2 d3 d4"]
        texts += [f"r{g}x4 a0"] if g % 2 else []
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted((d, *x) for d, x in brute.components(list(enumerate(texts)), 1, 60).items())
    assert sum(n == 10 and root != d for d, n, root in want) == 24
    assert sorted(map(tuple, jaccard_join.jaccard_components(docs, 1, 60).collect())) == want


@pytest.mark.parametrize("size,percent,words,known", [(1, 80, 14, 34), (2, 60, 7, 10)])
def test_jaccard_shingles_in_many_components(spark, size, percent, words, known):
    """All prefixes are of frequent shingles, which stand in many components: no link is lost."""
    rng = random.Random(words)
    texts = [" ".join(f"w{w}" for w in rng.sample(range(known), rng.randrange(max(1, words - 2), words + 3))) for _ in range(260)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted((d, *x) for d, x in brute.components(list(enumerate(texts)), size, percent).items())
    assert sorted(map(tuple, jaccard_join.jaccard_components(docs, size, percent).collect())) == want


def test_one_row_of_each_component_stays(spark):
    """Null ids and ids with several texts: each row is judged by itself."""
    near = "k1 k2 k3 k4 k5 k6 k7 k8 k9 k10 k11 k12 k13 k14 k15 k16 k17 k18 k19 k20 k21 k22 k23 k24 k25 k26 k27 k28 k29 k30"
    alone = [(None, "only null one here so alone"), (None, "another null row that nothing resembles"), (7, "first text of seven stays too"), (7, "second text of seven, quite another")]
    wordless = [(None, None), (None, ""), (7, " "), (7, " "), (7, None), (1, "")]
    copies = [(1, near), (4, near), (4, "row of four that is alone in the world"), (None, near + " k31"), (None, near)]
    nulls = [(None, "copies without any id at all here")] * 3
    equal = [(9, "nine comes twice with one text only")] * 2
    docs = spark.createDataFrame(alone + wordless + copies + nulls + equal, "doc_id long, text string").withColumn("first_tk", F.lit("clash"))
    kept = jaccard_join.deduplicate(docs, 4, 85)
    assert kept.columns == docs.columns
    want = alone + wordless + [copies[0], copies[2], nulls[0], equal[0]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(want, key=key)


def test_suffix_removal(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcd \n") for _ in range(4000))
    rows = [(1001, text[:900]), (1002, text[850:1800] + "é" * 60), (1003, "x" * 500), (1004, "x" * 49), (1005, "zz" + "x" * 50), (1006, text[100:149]), (1007, text[100:150]),
            (1008, None), (1009, ""), (1010, "ab" * 200 + text[3000:3100]), (1011, "ba" * 100 + "c"), (1012, text[:900]), (1013, "é" * 40)]
    docs = documents(spark, rows)
    want = sorted((d, *x) for d, x in brute.removed([tuple(r) for r in docs.collect()]).items())
    assert any(w[2] for w in want)
    assert sorted(map(tuple, suffix_dedup.remove_repeats(docs).collect())) == want


@pytest.mark.parametrize("size", [7, 30, 90])
def test_suffix_removal_of_other_sizes(spark, size):
    docs = documents(spark).where("doc_id % 4 = 0").unionByName(spark.createDataFrame([(3001, "abc" * 50), (3002, "bca" * 60 + "\0"), (3003, "c" * size), (3004, "c" * size)], "doc_id long, text string"))
    want = sorted((d, *x) for d, x in brute.removed([tuple(r) for r in docs.collect()], size).items())
    assert any(w[2] for w in want)
    assert sorted(map(tuple, suffix_dedup.remove_repeats(docs, size).collect())) == want


def test_suffix_removal_in_small_parts(spark, monkeypatch):
    docs = documents(spark, [(5000, "lorem ipsum " * 3000), (5001, "lorem ipsum " * 2000)])
    want = sorted((d, *x) for d, x in brute.removed([tuple(r) for r in docs.collect()]).items())
    monkeypatch.setattr(suffix_dedup, "PACK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "TEXT_BYTES", 5000)
    assert sorted(map(tuple, suffix_dedup.remove_repeats(docs.repartition(3), bucket_bytes=50_000).collect())) == want


@pytest.mark.parametrize("v", sorted(suffix_dedup.COVERS))
def test_difference_covers(v):
    cover = suffix_dedup.COVERS[v]
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("block", [37, 1 << 19])
def test_suffix_order(monkeypatch, block):
    """Equal windows of a text of many strings, in one block and in many; zeros at the ends."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng = random.Random(6)
    for size in (1, 2, 5, 20, 39, 50, 63, 120):
        for letters in ("ab", "abc\0", "abcdefgh \n"):
            base = "".join(rng.choice(letters) for _ in range(600)).encode()
            cuts = [(a := rng.randrange(480), base[a : a + size + rng.randrange(60)] + bytes(rng.randrange(2)))[1] for _ in range(40)]
            texts = [t for t in cuts if len(t) >= size]
            docs = np.array([rng.randrange(99) for _ in texts], np.int64)
            first: dict = {}
            windows = [t[i : i + size] for t in texts for i in range(len(t) - size + 1)]
            owners = [d for t, d in zip(texts, docs.tolist(), strict=True) for _ in range(len(t) - size + 1)]
            for w, d in zip(windows, owners, strict=True):
                first[w] = min(first.get(w, d), d)
            least, at = suffix_dedup.least_documents(texts, docs, size)
            assert least.tolist() == [first[w] for w in windows]
            assert at.tolist() == np.r_[0, np.cumsum([len(t) - size + 1 for t in texts])][:-1].tolist()


def test_suffix_ranks_give_the_order_of_suffixes():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(60, 90))).encode() for _ in range(30)]
    blocks = suffix_dedup.SuffixBlocks(texts, 50)
    places = np.concatenate([blocks.base[i] + np.arange(len(t) - 49) for i, t in enumerate(texts)])
    suffixes = [t[i:] for t in texts for i in range(len(t) - 49)]
    order, _ = blocks.sort_block(places, blocks.bytes_at(places, 0, 8))
    assert [suffixes[i] for i in order] == sorted(suffixes)


def test_suffix_edges(spark):
    docs = spark.createDataFrame([(1, "q" * 60), (1, "q" * 60), (None, "q" * 60), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(docs).collect()), key=key)
    assert got == sorted([(1, 60, 0), (1, 60, 0), (None, 60, 60), (None, 0, 0)], key=key)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_archives(spark):
    rows = [(3, "http://a/x y", "same"), (1, None, "same"), (2, "http://b\r\n", "é\r\n\r\nWARC/1.1"), (9, "u", None), (8, "u", ""), (None, "n", "same"), (4, "z", "q" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("offset", F.lit("clash"))
    pages = pages.unionByName(spark.read.parquet(f"{SF}/pages.parquet").select(F.col("page_id") + 100, "url", "html", F.lit("c")).toDF(*pages.columns))
    first = {}
    for p, _, h, _ in sorted(pages.collect(), key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h or "", p)
    want = []
    for p, _, h, _ in pages.collect():
        raw = (h or "").encode()
        again = first[h or ""] != p
        want.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    folder = fresh_path(spark, "warc-test")
    index = warc.write_archives(pages, folder, file_bytes=20_000)
    got = warc.read_records(index, folder, gap=100, most=5000).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert warc.read_records(index, folder, task_bytes=20_000).rdd.getNumPartitions() > 1
    some = warc.read_records(index.where("url = 'u'"), folder).collect()
    assert sorted(r.page_id for r in some) == [8, 9]
    assert warc.archive_round_trip(spark, pages.limit(0)).count() == 0


def test_joined_ranges():
    assert warc.join_ranges([(0, 10), (10, 5), (40, 5), (46, 100)], 10, 60) == [(0, 15, [(0, 10), (10, 5)]), (40, 45, [(40, 5)]), (46, 146, [(46, 100)])]


def test_feistel_is_a_permutation():
    f = pii.Feistel(b"k")
    for n in (1, 2, 3, 10, 97, 1000):
        assert sorted(f.permute(x, n, "t") for x in range(n)) == list(range(n))
        assert [f.permute(f.permute(x, n, "t"), n, "t", back=True) for x in range(n)] == list(range(n))
    odd = [x for x in range(500) if x % 3]
    assert sorted(f.permute(x, 500, "t", lambda v: v % 3 > 0) for x in odd) == odd


def test_pseudonyms(spark):
    card, bad = "4539 1488 0343 6467", "4539 1488 0343 6468"
    text = f"Mail ann.b-1@mail2.example.com or +1 (989) 555-2485, card {card} not {bad}, ip 70.214.118.188 v1.2.3.4.5, ssn 123-45-6789 not 000-45-6789, born 1984-02-29 = 29/02/1984 not 1985-02-29, iban GB82 WEST 1234 5698 7654 32."
    rows = [(1, text), (2, "again " + text), (3, None), (4, ""), (5, "no data " * 9000), (None, "4539148803436467")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_ip", F.lit("clash"))
    got = {r.doc_id: r for r in pii.pseudonymise(docs, "a").collect()}
    one = got[1]
    assert [one[f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1, 1, 1, 2]
    for old in ("ann.b-1@", "555-2485", card, "70.214.118.188", "123-45-6789", "1984-02-29", "29/02/1984", "WEST 1234"):
        assert old not in one.text
    for same in (bad, "v1.2.3.4.5", "000-45-6789", "1985-02-29", "@mail2.example.com", "+1 ("):
        assert same in one.text
    assert got[2].text == "again " + one.text and got[3].text is None and got[4].text == "" and got[5].text == rows[4][1]
    digits = re.sub(r"\D", "", re.search(r"card ([\d ]+) not", one.text)[1])
    assert pii.luhn_digit(digits[:-1]) == digits[-1] and got[None].text == digits
    iso, dotted = re.search(r"born (\d{4})-(\d\d)-(\d\d) = (\d\d)/(\d\d)/(\d{4})", one.text).groups()[:3], re.search(r"= (\d\d)/(\d\d)/(\d{4})", one.text).groups()
    assert iso == dotted[::-1]
    assert pii.iban_rest(re.search(r"iban ([A-Z0-9 ]+)\.", one.text)[1].replace(" ", "")) == 1
    assert pii.pseudonymise(docs, "other").where("doc_id = 1").first().text != one.text
    assert pii.pseudonymise(docs.limit(0), "a").count() == 0


def test_pseudonyms_turn_back(spark):
    """An exact round trip over whole documents: no value is lost, merged or changed twice."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    back = pii.Pseudonyms(b"a", back=True)
    hidden = {r.doc_id: r for r in pii.pseudonymise(docs, "a").collect()}
    changed = 0
    for r in docs.collect():
        new = hidden[r.doc_id]
        changed += new.text != r.text
        assert (new.text != r.text) == (sum(new[f"n_{k}"] for k in pii.KINDS) > 0)
        assert (None if r.text is None else back.replace(new.text)[0]) == r.text
    assert changed > 20


def test_every_kind_is_hidden_and_told_apart():
    """Many values of each kind and spelling: unequal ones get unequal pseudonyms of the same form, and these turn back."""
    forth, back = pii.Pseudonyms(b"a"), pii.Pseudonyms(b"a", back=True)
    days = [datetime.date(1999, 1, 1) + datetime.timedelta(i) for i in range(800)] + [datetime.date(y, 2, 28) for y in (1, 33, 1899, 2100, 2150, 9999)]
    luhn = [f"{x}{pii.luhn_digit(str(x))}" for x in range(453914880343646, 453914880343846)]
    values = {
        r"\d{4}-\d\d-\d\d": [d.isoformat() for d in days],
        r"\d{4}/\d\d/\d\d": [d.isoformat().replace("-", "/") for d in days],
        r"\d\d/\d\d/\d{4}": [f"{d.day:02d}/{d.month:02d}/{d.year:04d}" for d in days] + [f"{d.month:02d}/{d.day:02d}/{d.year:04d}" for d in days if d.day > 12],
        r"\d\d [A-Z][a-z]+ \d{4}": [f"{d.day:02d} {pii.MONTHS['en'][d.month - 1].capitalize()} {d.year:04d}" for d in days],
        r"[A-Z][a-z]+ \d\d, \d{4}": [f"{pii.MONTHS['short'][d.month - 1].capitalize()} {d.day:02d}, {d.year:04d}" for d in days],
        r"\d\d\. [A-Z][a-zä]+ \d{4}": [f"{d.day:02d}. {pii.MONTHS['de'][d.month - 1].capitalize()} {d.year:04d}" for d in days],
        r"\d\d de [a-z]+ de \d{4}": [f"{d.day:02d} de {pii.MONTHS['es'][d.month - 1]} de {d.year:04d}" for d in days],
        r"\d\d [a-zéû]+ \d{4}": [f"{d.day:02d} {pii.MONTHS['fr'][d.month - 1]} {d.year:04d}" for d in days],
        r"\d{10}": [str(5551234567 + i) for i in range(300)],
        r"0\d\d \d{7}": [f"030 {1234567 + i}" for i in range(300)],
        r"0\d \d\d \d\d \d\d \d\d": [f"01 23 45 67 {i:02d}" for i in range(100)],
        r"\+1 \(\d{3}\) \d{3}-\d{4}": [f"+1 (989) 555-{i:04d}" for i in range(300)],
        r"\d{16}": luhn,
        r"\d{3}-\d\d-\d{4}": [f"123-45-{i:04d}" for i in range(1, 300)],
        r"\d+\.\d+\.\d+\.\d+": [f"10.0.{i}.{j}" for i in range(20) for j in range(20)],
        r"[0-9a-f:]+": [str(ipaddress.IPv6Address(0x20010DB8 << 96 | i * 77)) for i in range(300)],
        r"[a-z]\.[a-z]{3}\d\d@x\.org": [f"a.bcd{i:02d}@x.org" for i in range(100)],
    }
    for form, own in values.items():
        new = [forth.replace(f"see {v}, then") for v in own]
        assert all(sum(n) == 1 and t != f"see {v}, then" for v, (t, n) in zip(own, new, strict=True)), form
        said = [t[4:-6] for t, _ in new]
        assert all(re.fullmatch(form, t) for t in said), form
        assert len(set(said)) == len(set(own)), form
        short = lambda t: re.sub(r"^([A-Z][a-z]{2})[a-z]*(?= \d\d, )", r"\1", t)  # noqa: E731  (May may be a whole name)
        assert [short(back.replace(f"see {t}, then")[0][4:-6]) for t in said] == [short(v) for v in own], form
    iso = {d: forth.replace(d.isoformat())[0] for d in days}
    for d in days:  # one reading of a date, however it is written
        assert forth.replace(f"{d.day:02d}.{d.month:02d}.{d.year:04d}")[0] == "{2}.{1}.{0}".format(*iso[d].split("-"))
    for same in ("::1", "std::vector", "12:30:45", "2020-02-30", "32/13/2020", "31 February 2020", "1234567890", "version 1.2.3.4.5"):
        assert forth.replace(same)[0] == same
