"""The corpus pipeline: five stages over ``documents``, each stored before the next reads it.

Every stage but the last returns the columns of ``documents``. Each works on all rows that its
predecessor kept, and handles nulls, empty and repeated rows as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.llm.common import documents, kept, shipped, table
from tidewatt.llm.decontam import without_leaks
from tidewatt.llm.lines import drop_repeated_lines
from tidewatt.llm.near import one_of_each
from tidewatt.llm.packing import packed
from tidewatt.llm.toxicity import fit_toxicity, reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar scores 0.7 or more go."""
    shipped(spark)
    return reject_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of five documents or more stay in one; ``n_chars`` follows the text."""
    shipped(spark)
    cut = drop_repeated_lines(docs)
    if "n_chars" not in cut.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, 0.8)."""
    shipped(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    shipped(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, in sequences of 2048 tokens."""
    import public_tokenizers

    shipped(spark)
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Scores, tokenizers and sampling have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
