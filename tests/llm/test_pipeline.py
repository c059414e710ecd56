"""The pipeline's stages, each against brute force on its own input."""

import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hydrolake.llm import packing, pii, quality_pu
from hydrolake.llm.common import materialize, table
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "jaccard_join", "decontamination", "pii", "packing"]
    good = materialize(corpus_pipeline.keep_good(spark, docs, SF), "t")
    scored = quality_pu.score_quality(docs, table(spark, SF, "labels"))
    assert ids(good) == ids(scored.where("predicted = 1")) and good.columns == docs.columns

    single = materialize(corpus_pipeline.drop_near_copies(spark, good, SF), "t")
    groups = brute.components([(r.doc_id, r.text) for r in good.collect()], 5, 80)
    assert ids(single) == sorted(d for d, (n, root) in groups.items() if not n or root == d)

    clean = materialize(corpus_pipeline.drop_contaminated(spark, single, SF), "t")
    items = [tuple(r) for r in table(spark, SF, "benchmark").select(F.col("item_id").cast("string"), "text").collect()]
    assert ids(clean) == sorted(r.doc_id for r in single.collect() if not brute.contamination(r.text, items)[4])

    hidden = materialize(corpus_pipeline.hide_personal_data(spark, clean, SF), "t")
    assert hidden.columns == docs.columns and ids(hidden) == ids(clean)
    own = pii.Pseudonyms(b"public test key")
    texts = {r.doc_id: r for r in hidden.collect()}
    for r in clean.collect():
        new = None if r.text is None else own.replace(r.text)[0]
        assert texts[r.doc_id].text == new and texts[r.doc_id].n_chars == (None if new is None else len(new))

    exact = Tokenizer.from_file(packing.public_files()[0])
    rows = corpus_pipeline.run(spark, SF).collect()
    brute.pieces_ok(rows, [(r.doc_id, r.text) for r in texts.values()], lambda t: exact.encode(t, add_special_tokens=False).ids)


def test_odd_input(spark):
    docs = spark.createDataFrame(
        [(1, None, "x", 1), (2, "", "x", 2), (None, "a b c d e f g", None, 3), (3, "a b c d e f g", "x", 4), (3, "a b c d e f g", "x", 4)],
        "doc_id long, text string, score string, n_ip int",
    ).withColumns({"_no_text": F.lit("clash"), "a.b": F.lit("dotted"), "_row": F.lit(1), "_whole": F.lit(2)})
    for df in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before, df = df, materialize(stage(spark, df, SF), name)
            assert df.columns == docs.columns
            if name == "pii":  # rows with null and repeated ids stay
                assert df.count() == before.count()
        packed = corpus_pipeline.pack(spark, df, SF)
        assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in df.collect()}
