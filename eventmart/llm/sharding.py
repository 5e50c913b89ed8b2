"""Sharding by weighted rendezvous hashing.

Each record scores every shard with a hash of its key and the shard's number, weighted as -weight / ln(u), and
goes to the best. A shard's share is its weight's; a further shard only takes records, and only those for which it
scores best, so nothing moves between the shards that were there. No shuffle places a record; numbering the
records of a shard shuffles their keys, in many parts a shard.

Null keys count as one key; equal keys share a shard; ties between shards go to the smaller number. Empty tables
give empty results; further columns are kept, and what is added gets underscores before its name where a column has that
name. Long texts are only measured. Rows of a shard are numbered in no meaningful order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import fresh, gapless, stored

_HEX = 13  # hex digits of the hash: 52 bits, exact in a double


def scores(key: Column, weights: Sequence[float]) -> Column:
    """Array of (score, -shard), one per shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above zero")
    text = F.coalesce(key.cast("string"), F.lit("null"))

    def score(weight: Column, shard: Column) -> Column:
        digits = F.substring(F.md5(F.concat_ws(":", text, shard.cast("string"))), 1, _HEX)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**_HEX))
        return F.struct((-weight / F.ln(u)).alias("score"), (-shard).alias("minus"))

    return F.transform(F.array(*(F.lit(float(w)) for w in weights)), score)


def best(scored: Column) -> Column:
    """The shard that scores best."""
    return -F.array_max(scored)["minus"]


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key among ``len(weights)`` shards."""
    return best(scores(key, weights))


def assign(df: DataFrame, key: str, weights: Sequence[float], new_weight: float = 1.0) -> DataFrame:
    """``df`` with ``shard`` and ``grown_shard``, the shard if one more of ``new_weight`` joined, as its last columns."""
    n = len(weights)
    shard, grown, pair = fresh(df, "shard", "grown_shard", "both")
    # The lambda keeps the scores in one projection, so that hashing happens once per shard and record.
    both = F.transform(
        F.array(scores(F.col(key), [*weights, new_weight])),
        lambda s: F.struct(best(F.slice(s, 1, n)).alias("shard"), best(s).alias("grown_shard")),
    )
    return (
        df.withColumn(pair, F.get(both, F.lit(0)))
        .withColumn(shard, F.col(pair)["shard"])
        .withColumn(grown, F.col(pair)["grown_shard"])
        .drop(pair)
    )


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str) -> None:
    """Write whole records to one folder per shard; a large shard is cut into several files."""
    shard = fresh(df, "shard")[0]
    (
        df.withColumn(shard, shard_of(F.col(key), weights))
        .hint("rebalance", shard)
        .write.partitionBy(shard).parquet(path)
    )


def shard_documents(documents: DataFrame, shards: int) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard; null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = documents.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = stored(assign(sized, "doc_id", [1.0] * shards), "shards")
    return gapless(placed, ["shard"], ["doc_id", "size", "text_crc32"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
