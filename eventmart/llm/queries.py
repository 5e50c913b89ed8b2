"""The operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (
    chat, decontamination, language_id, line_dedup, near_duplicates, nearest, personal_data, phrases, quality, spelling, url_filter,
)
from eventmart.llm.common import table
from eventmart.llm.packing import pack_documents
from eventmart.llm.sharding import shard_documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.report(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.sql(r"""SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
                         FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)""")
    return chat.digests(chat.render_turns(conversations.unionByName(trap)))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"), F.col("source"))
    return cleaned.select("doc_id", "text", "n_lines", "n_dropped")


def op5_line_dedup_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"), F.col("source"), distinct_texts=True)
    return cleaned.select("doc_id", "text", "n_lines", "n_dropped")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer, capacity=4096, end_id=1)


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return nearest.search(embeddings, embeddings.where("vec_id % 20 = 0"), k=20)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return personal_data.report(documents, personal_data.learn(documents))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = language_id.identify(documents, language_id.learn(documents))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    """All of these queries by name."""
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
