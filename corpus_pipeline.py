"""From documents to token ids: quality, near duplicates, benchmark passages, tokens.

Each stage reads the documents that the one before kept, in the columns of ``documents``;
the last returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyroll.llm import near, pieces, quality, tiling
from tallyroll.llm.common import read_table, staged
from tallyroll.llm.queries import VOCABULARY


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled rows of ``docs``."""
    return quality.good(docs, read_table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are similar at 0.8 or more, that with the smallest id.

    Similar ones are looked for in the groups of op6 and in those of equal positions of a longer fingerprint.
    """
    return near.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return tiling.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding them."""
    vocabulary = pieces.load_vocabulary(VOCABULARY, scores="rank")
    return pieces.tokenized(docs, vocabulary, "doc_id", "lang", "source")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", tokens_stage),
]

#: No stage can be said in SQL; tests compare the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
