from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventmart.llm import sharding
from tests.llm.rows import documents, documents_df


def _best(key, n: int) -> int:
    def score(s: int) -> float:
        u = (int(hashlib.md5(f"{'null' if key is None else key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        return -1 / math.log(u)

    return max(range(n), key=lambda s: (score(s), -s))


def test_against_brute_force(spark):
    rows = sharding.shard_documents(documents_df(spark), 40).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), _best(i, 40), _best(i, 41))
        for i, t, *_ in documents()
    )
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 40) for r in rows)


def test_weights_give_shares_and_stay_put(spark):
    ids = spark.range(4000).withColumn("shard", sharding.shard_of(F.col("id"), [1.0, 3.0]))
    heavy = ids.where("shard = 1").count()
    assert 2850 < heavy < 3150
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), [1.0, 0.0])


def test_whole_records_are_written(spark, tmp_path):
    df = documents_df(spark, clashing=True)
    sharding.write_shards(df, "doc_id", [1.0] * 4, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == df.count()
    assert set(back.columns) == {*df.columns, "shard"}


def test_columns_of_the_same_names_are_kept(spark, tmp_path):
    names = ("shard", "grown_shard", "_both", "_shard", "both")
    df = documents_df(spark).selectExpr("*", *(f"concat('{n}', doc_id) AS `{n}`" for n in names))
    placed = sharding.assign(df, "doc_id", [1.0] * 4)
    assert placed.columns == [*df.columns, "__shard", "_grown_shard"]
    assert Counter((r["doc_id"], r["shard"], r["_both"], r["__shard"], r["_grown_shard"]) for r in placed.collect()) == Counter(
        (i, None if i is None else f"shard{i}", None if i is None else f"_both{i}", _best(i, 4), _best(i, 5)) for i, *_ in documents()
    )
    sharding.write_shards(df, "doc_id", [1.0] * 4, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert set(back.columns) == {*df.columns, "__shard"} and back.count() == df.count()


def test_a_very_long_text(spark):
    text = "ñ" * 3_000_000
    row, = sharding.shard_documents(documents_df(spark, [(5, text, "es", "s", 1)]), 40).collect()
    assert (row["size"], row["text_crc32"], row["slot"]) == (6_000_016, zlib.crc32(text.encode()), 0)


def test_empty(spark):
    assert sharding.shard_documents(documents_df(spark, []), 40).collect() == []
