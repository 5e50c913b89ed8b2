from __future__ import annotations

import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from eventmart.llm import language_id as li
from tests.llm.rows import documents, documents_df, prose

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = li.learn(docs)
    rows = li.identify(docs, model).select("doc_id", "lang", "lang_pred", "score", li.held_out(docs.doc_id).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark):
    df = documents_df(spark, clashing=True)
    rows = li.identify(df, li.learn(df), ("guess", "sure")).collect()
    assert len(rows) == len(documents())
    for r in rows:
        blank = not r["text"] or not any(c.isalpha() for c in r["text"])
        assert (r["guess"] == "und") == blank
        assert r["score"] is None or r["score"].startswith("score")


def test_one_language_and_none(spark):
    df = documents_df(spark, [(i, f"some words {i}", "xx", "s", 1) for i in range(20)])
    assert {r["lang_pred"] for r in li.identify(df, li.learn(df)).collect()} == {"xx"}
    unknown = documents_df(spark, [(1, "words", None, "s", 1)])
    assert li.identify(unknown, li.learn(unknown)).collect()[0]["lang_pred"] == "und"
    none = documents_df(spark, [])
    assert li.identify(none, li.learn(none)).collect() == []


def test_chunks_count_like_the_whole(monkeypatch):
    text = documents()[0][1] * 5
    whole = li._counts(text)
    monkeypatch.setattr(li, "_CHUNK", 7)
    assert np.array_equal(whole, li._counts(text))


def test_repeated_rows_teach_once(spark, monkeypatch):
    texts = documents_df(spark, [(i, prose(i, 30), "en" if i % 2 else "fr", "s", 1) for i in range(200)]).where(~li.held_out(F.col("doc_id")))
    rows = [tuple(r) for r in texts.orderBy(F.xxhash64("doc_id", "text")).collect()]
    taught = []
    monkeypatch.setattr(li, "Model", lambda x, langs: taught.append((x, langs)))
    collected = []
    to_pandas = DataFrame.toPandas
    monkeypatch.setattr(DataFrame, "toPandas", lambda self: collected.append(to_pandas(self)) or collected[-1])
    li.learn(documents_df(spark, rows + rows[:1] * 500), sample=40)
    x, langs = taught[0]
    assert len(collected[0]) == len(x) == len({v.tobytes() for v in x}) == 40
    assert sorted(langs) == ["en"] * 20 + ["fr"] * 20


def test_held_out_texts_are_scored_once(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = li.learn(docs)
    docs = docs.withColumn("lang", F.when(F.crc32("text") % 3 == 0, "en").otherwise(F.col("lang")))  # some of them wrong
    scores = defaultdict(list)
    for r in li.identify(docs.where(li.held_out(docs.doc_id)), model).where("lang = lang_pred").collect():
        scores[r["lang"]].append(int(r["score"] * 10_000))
    expected = {lang: max(sorted(s)[len(s) // 10] - 1, 0) / 10_000 for lang, s in scores.items() if len(s) >= 10}
    plans = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or collect(self))
    assert li.least_scores(docs, model, unsure=0.1) == expected
    assert len(expected) > 1
    assert [p.count("ArrowEvalPython") for p in plans] == [1]


def test_machines_are_fitted_in_few_copies_of_the_sample(spark):
    docs = documents_df(spark, [(i, prose(i, 30), "en" if i % 2 else "fr", "s", 1) for i in range(2000)])
    li.learn(docs, sample=10)
    tracemalloc.start()
    try:
        li.learn(docs, sample=1000)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 4 * 1000 * 2 * li._DIMS


def test_features_are_made_in_one_copy():
    texts = [prose(i, 40) for i in range(400)] + [None, "", "12 34"]
    li.features(texts[:2])
    tracemalloc.start()
    try:
        x = li.features(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    counts = np.stack([li._counts(t) if t else np.zeros(li._DIMS) for t in texts])
    assert np.array_equal(x, np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32))
    assert most < 2 * x.nbytes
