from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventmart.llm import language_id
from eventmart.llm.common import table
from tests.llm.rows import documents, documents_df, prose
from tests.llm.test_decontamination import _brute as brute_contamination
from tests.llm.test_line_dedup import _brute as brute_lines
from tests.llm.test_near_duplicates import brute_classes

ITEMS = [(1, prose(900, 30)), (2, prose(901, 30))]


def _rows():
    menu = "Home and menu and search and login and help of this site"
    rows = documents()
    rows += [(500 + i, f"{menu}\n{prose(600 + i, 80)}", "en" if i % 2 else "de", "shop", 1) for i in range(30)]
    rows += [(700, prose(800, 60) + " " + ITEMS[0][1], "en", "s", 1), (701, prose(802, 60), "en", "s", 1), (702, "12 34 %%", "en", "s", 1)]
    return rows


def test_stages_against_brute_force(spark, tmp_path):
    documents_df(spark, _rows()).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = table(spark, str(tmp_path), "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = stage(spark, docs, str(tmp_path))
        after = [tuple(r) for r in docs.collect()]
        seen[name] = (before, after)
        if name != "packing":
            assert docs.columns == columns
            docs = spark.createDataFrame(after, docs.schema)

    before, after = seen["language"]
    lettered = [r for r in before if r[1] and any(c.isalpha() for c in r[1])]
    assert set(after) <= set(lettered)
    assert len(after) >= 0.9 * len(lettered)
    before, after = seen["lines"]
    expected = brute_lines(before, 0.05, 3)
    assert {(r[0], r[1]) for r in after} == set(expected)
    assert all(r[4] == len(r[1]) for r in after)
    before, after = seen["near_duplicates"]
    assert len(after) == len(brute_classes(before))
    assert set(after) <= set(before)
    before, after = seen["benchmark"]
    bad = {k[0] for k in brute_contamination(before, ITEMS) if k[-1]}
    assert bad == {700}
    assert sorted(r[0] or -1 for r in after) == sorted(r[0] or -1 for r in before if r[0] not in bad)
    before, after = seen["packing"]
    assert {r[0] for r in after} == {r[0] for r in before}
    assert sum(r[1] == 0 for r in after) == len(before)


def test_run_is_the_stages_in_order(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 150 < rows.select("doc_id").distinct().count() <= 200


def test_stages_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents_df(spark, []), str(tmp_path)).collect() == []


def test_uncertain_documents_are_those_below_even_odds():
    assert corpus_pipeline.LEAST_SCORE == 0.5 * 0.5
    assert language_id.UNKNOWN == "und"


def test_unlearned_languages_and_random_letters_go_by_score(spark):
    r = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    unlike = [
        "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem",
        "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
        *(" ".join("".join(r.choices(letters, k=r.randint(2, 9))) for _ in range(n)) for n in (20, 200)),
    ]
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    planted = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(unlike)], docs.schema)
    found = corpus_pipeline.identify_language(spark, docs.unionByName(planted), "")
    assert found.where("doc_id < 0").count() == 0
    lettered = docs.where(language_id.held_out(docs.doc_id) & F.col("text").rlike("[A-Za-z]"))
    before, after = (dict(d.groupBy("lang").count().collect()) for d in (lettered, found.where(language_id.held_out(found.doc_id))))
    assert len(before) == 4
    assert all(after[lang] >= 0.98 * n for lang, n in before.items())


def test_few_held_out_documents_give_no_least_score(spark):
    df = documents_df(spark)
    assert language_id.least_scores(df, language_id.learn(df)) == {}


@pytest.mark.parametrize(("before", "after"), [("10000", 1024), ("0", 1024), ("100", 100)])
def test_workers_get_small_batches_of_texts(spark, monkeypatch, before, after):
    name, sizes = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    kept = spark.conf.get(name)
    spark.conf.set(name, before)
    try:
        docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "'some text' AS text")
        monkeypatch.setattr(corpus_pipeline.near_duplicates, "keep_one", lambda docs: docs)
        found = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "")
        sizes = [r["n"] for r in found.mapInPandas(lambda ps: (pd.DataFrame({"n": [len(p)]}) for p in ps), "n long").collect()]
    finally:
        spark.conf.set(name, kept)
    assert sum(sizes) == 3000
    assert max(sizes) == after
