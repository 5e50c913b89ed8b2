"""A pipeline over ``documents``: each stage's rows are written and read again as the next stage's documents.

A stage works on all that the one before kept. The first four return the columns of ``documents``; the last returns the
packed pieces of what is left. Nulls, blank texts and repeated rows are treated as the operators' modules say; a stage of
an empty table is empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import decontamination, language_id, line_dedup, near_duplicates, packing
from eventmart.llm.common import fresh, small_batches, stored, table

#: Below even odds for both the family and the language within it, a document has no language. With two classes each no
#: score is below, so a language's own least score, from its held-out documents, decides where enough of them are known.
LEAST_SCORE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that was learned; those without letters go, and those that score less than all but 0.005 of
    the language's held-out documents. Languages with fewer than 200 of these have ``LEAST_SCORE`` alone."""
    small_batches(spark)
    lang, score = fresh(docs, "lang_pred", "score")
    model = language_id.learn(docs)
    found = language_id.identify(docs, model, (lang, score))
    least = F.lit(LEAST_SCORE)
    for name, reached in sorted(language_id.least_scores(docs, model).items()):
        least = F.when(F.col(lang) == name, max(reached, LEAST_SCORE)).otherwise(least)
    sure = (F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= least)
    return found.where(sure).select(docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without the lines that are boilerplate of their source; n_chars follows the text."""
    cleaned = line_dedup.drop_boilerplate(docs, F.col("source"), counts=None)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    small_batches(spark)
    return near_duplicates.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are within passages of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 4096 tokens."""
    small_batches(spark)
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, tokenizer, capacity=4096, end_id=1)


STAGES = [
    ("language", identify_language),
    ("lines", drop_boilerplate),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("benchmark", decontaminate),
    ("packing", pack),
]

#: Support vector machines and token ids can't be had in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
