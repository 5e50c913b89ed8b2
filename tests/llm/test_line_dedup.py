from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from eventmart.llm import line_dedup
from tests.llm.rows import DOCUMENT, documents, documents_df, prose


def _brute(rows, ratio, least):
    pages, on = Counter(), defaultdict(Counter)
    for _, text, _, site, _ in rows:
        pages[site] += 1
        on[site].update({l for l in (text or "").split("\n") if l.strip(" ")} if text is not None else set())
    bad = {s: {l for l, n in c.items() if n >= least and n > ratio * pages[s]} for s, c in on.items()}
    return Counter(
        (i, None if t is None else "\n".join(l for l in t.split("\n") if l not in bad[s])) for i, t, _, s, _ in rows
    )


def test_against_brute_force(spark):
    rows = documents() + [
        (100 + i, f"menu\nhome\n{i % 3} of it\nown line {i}\n\nmenu", "en", "big" if i % 4 else None, 1) for i in range(40)
    ]
    got = line_dedup.drop_boilerplate(documents_df(spark, rows), F.col("source"), 0.4, 3).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == _brute(rows, 0.4, 3)
    menu = next(r for r in got if r["doc_id"] == 101)
    assert (menu["n_lines"], menu["n_dropped"]) == (6, 3)
    assert next(r for r in got if r["doc_id"] == 1)["n_lines"] == 0


def test_small_sites_keep_their_lines(spark):
    rows = [(1, "a\nb", "en", "s", 1), (2, "a\nc", "en", "s", 1)]
    assert line_dedup.boilerplate(spark.createDataFrame(rows, DOCUMENT), F.col("source")).collect() == []


def test_copies_are_one_page_of_distinct_texts(spark):
    copy = prose(50, 20) + "\n" + prose(51, 20)
    rows = [(i, copy if i < 5 else f"menu\n{prose(60 + i, 20)}", "en", "s", 1) for i in range(20)]
    rows += [(100 + i, None, "en", "s", 1) for i in range(3)]
    df = documents_df(spark, rows)
    drop = line_dedup.boilerplate(df, F.col("source"), distinct_texts=True).collect()
    assert [r["_drop"] for r in drop] == [["menu"]]
    got = line_dedup.drop_boilerplate(df, F.col("source"), distinct_texts=True).collect()
    assert [r["text"] for r in got if r["doc_id"] < 5] == [copy] * 5
    assert Counter((r["doc_id"], r["text"]) for r in line_dedup.drop_boilerplate(df, F.col("source")).collect()) == _brute(rows, 0.05, 3)


def test_columns_stay(spark):
    df = documents_df(spark, clashing=True)
    out = line_dedup.drop_boilerplate(df, F.col("source"), counts=None)
    assert out.columns == df.columns
    assert out.where("n_lines IS NOT NULL").head()["n_lines"].startswith("n_lines")


def test_host(spark):
    urls = spark.createDataFrame([("https://M.Example.com/a?b=1",), ("no url",), (None,)], "url string")
    assert [r[0] for r in urls.select(line_dedup.host(F.col("url"))).collect()] == ["m.example.com", None, None]


def test_empty(spark):
    assert line_dedup.drop_boilerplate(documents_df(spark, []), F.col("source")).collect() == []
