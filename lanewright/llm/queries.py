"""One query an operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.llm import (
    byte_bpe,
    chat_quotes,
    collocations,
    decontaminate,
    exact_dedup,
    hard_negatives,
    license_scan,
    ngram_join,
    piece_bpe,
    token_store,
    toxicity,
    url_filter,
    warc,
)
from lanewright.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2

URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_matches(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_store.write_tokens(
        table(spark, sf_dir, "documents"), tokenizer_path=TOKENIZER, end_id=END_ID
    )
    return token_store.token_digest(token_store.read_tokens(files))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op6_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = chat_quotes.reply_ordered(table(spark, sf_dir, "conversations"))
    return ordered.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.page_digest(warc.read_archives(archives))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.piece_digest(table(spark, sf_dir, "documents"), model_path=PIECE_MODEL)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filter.parse_rule(*r) for r in URL_RULES]
    rules = spark.createDataFrame(rules, "rule string, host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encoding_digest(table(spark, sf_dir, "documents"), tokenizer_path=BYTE_TOKENIZER)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, is_anchor=F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_ngram_jaccard_join,
        op3_toxicity,
        op4_token_store,
        op5_exact_dedup,
        op6_chat_quotes,
        op7_warc,
        op8_decontamination,
        op9_sentencepiece,
        op10_url_filter,
        op11_collocations,
        op12_byte_bpe,
        op13_hard_negatives,
    )
}
