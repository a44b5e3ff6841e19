"""One query for each operator, over its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm import alignment, chat, html_text, mixing, phrases, pieces, quality, shards, simhash, tiling, topk, urls, warc
from tallyroll.llm.common import read_table
from tallyroll.llm.oracle import ORACLE  # noqa: F401

#: The public vocabulary that ``op1_sentencepiece`` reads, and the one that ``op13_alignment`` aligns with it.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"

#: The rules of ``op3_urls``.
RULES = [
    urls.Rule("org/", "allow"),
    urls.Rule("example.org/es/", "block"),
    urls.Rule("example.org/en/1", "block"),
    urls.Rule("com/fr/", "allow"),
    urls.Rule("com/de/", "block"),
]
SHARDS = 40


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load_vocabulary(VOCABULARY, scores="rank")
    return pieces.tokenized(read_table(spark, sf_dir, "documents"), vocabulary, "doc_id")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    every = turns.unionByName(more).select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    return chat.read_back(chat.formatted(every))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = spark.createDataFrame(urls.LABELLED, "url string, label int")
    return urls.judged(read_table(spark, sf_dir, "pages"), RULES, urls.fit(labelled))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.classified(docs, model, "doc_id").select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(read_table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(read_table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op8_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_by_source(read_table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(read_table(spark, sf_dir, "documents"), BYTE_LEVEL, VOCABULARY)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_chat, op3_urls, op4_quality, op5_html, op6_simhash, op7_shards, op8_tiling, op9_topk, op10_warc, op11_phrases,
        op12_mixing, op13_alignment
    )
}
