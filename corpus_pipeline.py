"""A training corpus from raw documents, in five stages.

Each stage takes the documents its predecessor kept and is written as Parquet to the
shared folder before the next one reads them, so a lost executor costs one stage's tasks.
All columns pass through every stage; the last adds the piece ids and the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import decontaminate, language, line_dedup, pieces, simhash
from brindle.llm.common import fresh, table
from brindle.plans.workspace import materialize


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; those without letters or without a clear language go."""
    return language.known_language_only(docs, language.fit(docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of the document's source go; ``n_chars`` follows the text."""
    cleaned = line_dedup.drop_boilerplate(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(cleaned.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints at most three bits apart stays: that with the smallest id."""
    return simhash.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``piece_ids`` and ``decoded``, the text these ids spell."""
    return pieces.with_pieces(docs, pieces.vocabulary_for(spark), names=tuple(fresh(docs.columns, "piece_ids", "decoded")))


STAGES = [
    ("language", identify),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pieces", encode),
]

# Naive Bayes, fingerprints, edit distance and Viterbi are beyond SQL; tests hold the rows
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
