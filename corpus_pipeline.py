"""Training-data pipeline over documents: quality, near copies, decontamination, pseudonyms, packing.

Each stage is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolake.llm import decontaminate, jaccard_join, packing, pii, quality_pu
from hydrolake.llm.common import materialize, ship, table


def whole_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and all else as one column, so no column of a stage can clash with the documents'."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select("doc_id", "text", F.struct(F.col("text").isNull().alias("no_text"), rest.alias("rest")).alias("_row"))


def documents_of(found: DataFrame, columns: list[str]) -> DataFrame:
    """The documents again, from _row and _whole."""
    text = F.when(~F.col("_row.no_text"), F.col("_whole")).alias("text")
    return found.select(*[text if c == "text" else F.col(f"_row.rest.`{c}`").alias(c) for c in columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; without anything to learn from, all."""
    scored = quality_pu.score_quality(whole_rows(docs), table(spark, sf_dir, "labels"), keep=["_row"], with_text=True)
    return documents_of(scored.where("predicted = 1"), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles with a similarity of 0.8 or more."""
    ship(spark)
    return jaccard_join.deduplicate(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows hit less than a twentieth of the words."""
    found = decontaminate.find_contamination(whole_rows(docs), table(spark, sf_dir, "benchmark"), keep=["_row"], with_text=True)
    return documents_of(found.where("not (n_hit > 0 and 20 * n_hit >= n_words)"), docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms under the session's key (``spark.hydrolake.pseudonym.key``); n_chars follows the text.

    Null text stays null, empty text empty; rows with null or repeated ids are rows like others.
    """
    ship(spark)
    return pii.pseudonymised_documents(docs, pii.session_key(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document in a sequence of at most 1024 tokens. Null text counts as empty: one piece, the end id."""
    ship(spark)
    return packing.pack_documents(docs, *packing.public_files())


STAGES = [
    ("quality_classifier", keep_good),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("packing", pack),
]

#: SQL can't express the classifier, the keyed permutation or the tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
