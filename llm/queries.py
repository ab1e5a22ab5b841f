"""The registered queries of the operators, with the parameters of production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from llm import bpe, chunks, dialogue, html_text, jaccard, lexical, mixing, quality, secrets, sharding, token_files, toxicity, vectors
from llm.common import documents, need, table

#: Target shares of the mix; all other sources together are "other".
MIX = {"src0": 0.2, "src1": 0.1, "src2": 0.1, "src3": 0.1, "other": 0.5}
MIX_BLOCK_ROWS = 16
SHARD_WEIGHTS = [1.0] * 16
TOXIC_FROM = toxicity.REJECT


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_pq_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op4_rendezvous_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(table(spark, folder, "documents"), SHARD_WEIGHTS)


def op5_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.positions(table(spark, folder, "documents"), MIX, MIX_BLOCK_ROWS)


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    return token_files.digests(table(spark, folder, "documents"), definition)


def op7_toxic_severity(spark: SparkSession, folder: str) -> DataFrame:
    docs = need(table(spark, folder, "documents"), doc_id="long", text="string")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model, TOXIC_FROM).drop("text")


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(table(spark, folder, "documents"))


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(table(spark, folder, "pages"))


def op10_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.dedup(documents(table(spark, folder, "documents")))


def op11_dual_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return dialogue.repair(dialogue.damaged(table(spark, folder, "conversations")))


def op13_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_pq_near_dedup, op3_byte_bpe, op4_rendezvous_shards, op5_pfair_mix, op6_token_files, op7_toxic_severity,
    op8_ngram_jaccard, op9_main_text, op10_chunk_dedup,
    op11_dual_tree_search, op12_conversation_repair, op13_secret_spans)}

ORACLE_SQL: dict[str, str] = {
    "op5_pfair_mix": mixing.oracle_sql(MIX, MIX_BLOCK_ROWS), "op11_dual_tree_search": lexical.ORACLE_SQL}
