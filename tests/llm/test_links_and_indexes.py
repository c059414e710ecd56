"""Phone numbers in all spellings, written dates, kept trigram indexes, many matches, deep hosts."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from hydrolake.llm import pii, secrets, url_filter
from hydrolake.llm.common import fresh_path
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def spellings(code, own):
    """Ways to write an international number of ten or eleven national digits."""
    a, b, c = own[:3], own[3:6], own[6:]
    out = [f"+{code}{own}", f"+{code} {a} {b} {c}", f"+{code}-{a}-{b}-{c}", f"+{code}.{a}.{b}.{c}"]
    if len(own) == 10:
        out += [f"+{code} ({a}) {b}-{c}", f"+{code} ({a}) {b} {c}"]
    if code == "1":
        out += [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", own]
    return out


def test_a_number_has_one_pseudonym():
    names, back, rng = pii.Pseudonyms(b"a"), pii.Pseudonyms(b"a", back=True), random.Random(1)
    seen = {}
    for code, n in [("1", 10), ("7", 10), ("49", 10), ("44", 10), ("353", 9), ("420", 9), ("1", 10), ("91", 10)] * 40:
        own = str(rng.randrange(2, 10)) + "".join(str(rng.randrange(10)) for _ in range(2)) + str(rng.randrange(2, 10)) + "".join(str(rng.randrange(10)) for _ in range(n - 4))
        found = set()
        for text in spellings(code, own):
            new, counts = names.replace(f"call {text}, please")
            said = new[5:-8]
            assert counts[pii.KINDS.index("phone")] == 1 and re.sub(r"\d", "0", said) == re.sub(r"\d", "0", text)
            assert back.replace(new)[0] == f"call {text}, please"
            digits = re.sub(r"\D", "", said)
            if text.startswith("+"):
                assert digits.startswith(code)
                digits = digits[len(code) :]
            found.add(digits)
        assert len(found) == 1
        seen.setdefault((code, n), {})[own] = found.pop()
    for of in seen.values():
        assert len(set(of.values())) == len(of)


def test_country_codes_part_uniquely():
    codes = {pii.country_code(f"{k:03d}0000") for k in range(1000)}
    assert not any(a != b and b.startswith(a) for a in codes for b in codes)
    assert pii.country_code("4915112345678") == "49" and pii.country_code("19895552485") == "1" and pii.country_code("353861234567") == "353"


def test_more_ways_to_write_a_date():
    names, back = pii.Pseudonyms(b"a"), pii.Pseudonyms(b"a", back=True)
    iso = names.replace("2020-03-12")[0]
    year, month, day = iso.split("-")
    assert names.replace("12-03-2020")[0] == f"{day}-{month}-{year}"
    for text in ("5th of March 2020", "March 5th, 2020", "21ST OF MAY 1999", "2nd June 2001", "12 of July 1980"):
        new, counts = names.replace(f"on {text}.")
        assert counts[-1] == 1 and new != f"on {text}." and re.sub(r"\b0(?=\d)", "", back.replace(new)[0]) == f"on {text}."
    want = names.replace("2020-03-05")[0].split("-")
    said = re.fullmatch(r"(\d+)(st|nd|rd|th) of (\w+) (\d{4})", names.replace("5th of March 2020")[0])
    assert (int(said[1]), said[4]) == (int(want[2]), want[0]) and said[2] == pii.ordinal(int(said[1]))
    assert names.replace("5st of March 2020")[0] == "5st of March 2020"


def test_many_matches_in_a_text(spark):
    """Spans are summed in linear time."""
    text = "token=abcdefg " * 60_000 + "x"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.perf_counter()
    row = secrets.secret_report(docs).first()
    took = time.perf_counter() - began
    assert (row.n_assign, row.n_access, row.n_hex, row.base_sha256) == brute.secrets(text)
    assert took < 100  # 7 s on a warm machine that does nothing else


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_spans_at_the_borders_of_chunks(spark, n):
    text = "é" + "secret: abcdef, token=x " * n + "AKIA" + "B" * 30
    row = secrets.secret_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_assign, row.n_access, row.n_hex, row.base_sha256) == brute.secrets(text)


def test_a_kept_index_decides(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, "my passphrase is zebra-zulu, token=abcdefgh"), (-1, None), (None, "token=abcdefgh")], "doc_id long, text string"))
    rules = [r for r in secrets.BASE_RULES if r.kind != "hex"]
    want = sorted(map(str, secrets.scan_secrets(docs, rules).collect()))
    index = secrets.build_index(docs, rules, fresh_path(spark, "index"))
    assert sorted(map(str, secrets.scan_secrets(docs, rules, index=index).collect())) == want
    monkeypatch.setattr(secrets, "FILTERED", 0)  # all texts go to meet the candidates
    assert sorted(map(str, secrets.scan_secrets(docs, rules, index=index).collect())) == want
    monkeypatch.undo()
    new = secrets.SecretRule("zulu", "zebra-zulu", 0, 1)
    with pytest.raises(ValueError, match="extend_index"):
        secrets.scan_secrets(docs, [*rules, new], index=index)
    wider = secrets.extend_index(docs, index, [*rules, new])
    assert len(wider.trigrams) > len(index.trigrams)
    monkeypatch.setattr(secrets, "postings", None)  # a later scan reads postings and makes none
    found = secrets.scan_secrets(docs, [*rules, new], index=wider).where(F.exists("found", lambda x: x["kind"] == "zulu")).collect()
    assert [r.doc_id for r in found] == [-1]


def test_hosts_of_many_labels(spark):
    rules = [url_filter.Rule(*r) for r in brute.URL_RULES]
    urls = ["http://" + "a." * 3000 + "com/x", "http://" + "b." * 3000 + "www.example.com/en/1", "https://x.example.com/en/", "http://com/", "http://org", "http://a.net/fr/x", "http://.net/es/", None, ""]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    for k, u in enumerate(urls):
        host, path, rule, verdict = brute.url(u)
        assert got[k] == (host, path, rule, verdict or "allow")
    assert url_filter.judge_urls(pages, rules).agg(F.max("n_keys")).first()[0] <= 3 * len({len(r.path) for r in rules})


def test_packing_again_gives_the_same(spark):
    """Sequences are equal in each run over the same files, and copies of a row are spread over the groups."""
    from hydrolake.llm import packing

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    runs = [sorted(map(tuple, packing.pack_documents(docs, *packing.public_files(), pieces_per_group=40).collect())) for _ in range(2)]
    assert runs[0] == runs[1]
    same = spark.range(200).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    assert len({r.sequence_id >> 32 for r in packing.pack_documents(same, *packing.public_files(), pieces_per_group=10).collect()}) > 10
