from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from eventmart.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, queries, k):
    out = {}
    for q in queries:
        vector = np.array(next(v for i, v in rows if i == q), float)
        scored = sorted((-float((np.array(v, float) * vector).sum()), i) for i, v in rows if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def _found(df, where, k):
    out = defaultdict(list)
    for r in sorted(nearest.search(df, df.where(where), k).collect()):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return dict(out)


def test_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = _found(df, "vec_id % 100 = 0", 20)
    truth = _brute(rows, list(found), 20)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in truth[q]}) for q in truth)
    assert hits >= 0.9 * sum(map(len, truth.values()))
    scores = {q: dict(t) for q, t in _brute(rows, list(found)[:3], len(rows)).items()}
    for q, all_scores in scores.items():
        assert all(s == pytest.approx(all_scores[i], abs=1e-12) for i, s in found[q])


def test_awkward_vectors_and_ties(spark):
    good = [(i, [float(i % 3), 1.0, 0.5 * (i % 2)]) for i in range(30)]
    bad = [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 0.0]), (104, [float("nan"), 1.0, 1.0]),
           (105, [float("inf"), 1.0, 1.0]), (106, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in good + bad], SCHEMA).selectExpr("*", "1 AS list", "'x' AS vector")
    assert _found(df, "vec_id % 5 = 0", 7) == _brute(good, range(0, 30, 5), 7)


def test_fewer_candidates_than_asked_for(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)], 0) for i in range(4)], SCHEMA)
    assert {q: len(f) for q, f in _found(df, "vec_id % 2 = 0", 20).items()} == {0: 3, 2: 3}


def test_a_large_list_is_cut(spark, monkeypatch):
    monkeypatch.setattr(nearest, "_PART", 16)
    monkeypatch.setattr(nearest, "_QUERIES", 4)
    rows = [(i, [1.0, 1.0] if i % 2 else [1.0, i / 100]) for i in range(120)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    stored = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    found, truth = _found(df, "vec_id % 10 = 0", 5), _brute(stored, range(0, 120, 10), 5)
    assert {q: [i for i, _ in f] for q, f in found.items()} == {q: [i for i, _ in f] for q, f in truth.items()}


def test_empty(spark):
    assert nearest.search(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], SCHEMA), 5).collect() == []


def test_most_candidates_are_abandoned_early_and_none_of_the_nearest():
    x = np.stack(pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_list()).astype(float)
    ids, norm, d = np.arange(len(x)), np.linalg.norm(x, axis=1).max(), x.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(1).standard_normal((d + 1, d + 1)))[0]
    lists = nearest.Lists(norm, rotation, np.zeros((1, d + 1), np.float32))
    turned, asked = lists.turned(x, is_query=False), np.arange(0, len(x), 20)
    q_turned = lists.turned(x[asked], is_query=True)
    truth = {a: np.lexsort((ids, -(x @ x[a]) + 9 * (ids == a)))[:20] for a in asked}
    # The radius of a query from a tenth of the candidates, as its nearest lists would give it.
    first = nearest.scan(x[::10], turned[::10], ids[::10], x[asked], q_turned, asked, np.full(len(asked), -np.inf), norm, 20)
    least = first.scores.reshape(len(asked), 20)[:, -1]
    found = nearest.scan(x, turned, ids, x[asked], q_turned, asked, least, norm, 20)
    pairs = len(asked) * (len(x) - 1)
    assert found.scored < 0.2 * pairs
    got = {a: set(found.ids[found.query == n]) for n, a in enumerate(asked)}
    assert sum(len(got[a] & set(truth[a])) for a in asked) >= 0.97 * 20 * len(asked)


def test_one_row_is_a_third_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(nearest, "_PART", 16)
    rows = [(i, [1.0 + i / 64, 1.0]) for i in range(80)] + [(7, [3.0, 4.0])] * 40
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    vector = np.array([1.0 + 20 / 64, 1.0])
    scored = sorted((-float(np.array(v) @ vector), i) for i, v in rows if i != 20)[:45]
    assert _found(df, "vec_id = 20", 45)[20] == [(i, -s) for s, i in scored]
    assert 7 not in {i for i, _ in _found(df, "vec_id = 7", 45)[7]}
