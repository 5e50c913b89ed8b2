from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from eventmart.llm import near_duplicates as nd
from eventmart.llm.components import components
from tests.llm.rows import documents, documents_df, prose

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def brute_classes(rows):
    """Sets of row numbers, from all pairs of texts."""
    sets = []
    for _, text, *_ in rows:
        w = _WORD.findall((text or "").translate(_LOWER))
        k = min(5, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = rows[i][1] is not None and rows[i][1] == rows[j][1]
            if same or (a and b and len(a & b) >= 0.8 * len(a | b)):
                parent[find(i)] = find(j)
    out = defaultdict(list)
    for i in range(len(rows)):
        out[find(i)].append(i)
    return list(out.values())


def _family(n: int, seed: int):
    """Copies of one text of which each has some words changed, so that many are near, and many are not."""
    r, base = random.Random(seed), prose(seed, 150).split()
    for i in range(n):
        words = list(base)
        for _ in range(r.randint(0, 9)):
            words[r.randrange(150)] = f"edit{r.randint(0, 99)}"
        yield 1000 * seed + i, " ".join(words), "en", "s", 1


def test_classes_against_brute_force(spark):
    rows = documents() + list(_family(40, 7)) + list(_family(25, 8))
    got = nd.report(documents_df(spark, rows, clashing=True)).collect()
    expected = Counter()
    for members in brute_classes(rows):
        ids = [rows[i][0] for i in members]
        least = min((i for i in ids if i is not None), default=None)
        expected.update((i, least, len(ids)) for i in ids)
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == expected


def test_the_rest_is_compared_pair_by_pair(spark, monkeypatch):
    monkeypatch.setattr(nd, "ROUNDS", 0)
    rows = list(_family(60, 9))
    sizes = Counter(len(m) for m in brute_classes(rows) for _ in m)
    assert Counter(r["class_size"] for r in nd.report(documents_df(spark, rows)).collect()) == sizes


def test_one_of_each_class_stays(spark):
    rows = documents() + list(_family(20, 7))
    df = documents_df(spark, rows, clashing=True)
    kept = nd.keep_one(df)
    assert kept.columns == df.columns
    classes = brute_classes(rows)
    which = {i: c for c, members in enumerate(classes) for i in members}
    by_row = defaultdict(set)
    for i, row in enumerate(rows):
        by_row[row[:2]].add(which[i])
    left = Counter(c for r in kept.collect() for c in by_row[(r["doc_id"], r["text"])] if r["text"] is not None)
    assert set(left.values()) == {1}
    assert len(left) == len([m for m in classes if rows[m[0]][1] is not None])
    assert kept.where("text IS NULL").count() == sum(r[1] is None for r in rows)


def test_coordinates_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(3)
    elements = np.arange(1, 301, dtype=np.uint64)
    a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
    signature = nd.signatures([elements, elements], [a, b], 4000)
    alike = (signature[0] == signature[1]).mean()
    assert abs(alike - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_sketches_differ_in_no_more_places_than_sets():
    rng = np.random.default_rng(4)
    for n in (1, 5, 40, 700):
        a = np.unique(rng.integers(0, 2**60, n).astype(np.uint64))
        for changed in range(0, n + 1, max(1, n // 6)):
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 2**60, changed // 2).astype(np.uint64)]))
            wa, wb = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
            wb[: changed // 3] = 3
            weight_a, weight_b = dict(zip(a.tolist(), wa, strict=True)), dict(zip(b.tolist(), wb, strict=True))
            apart = sum(abs(weight_a.get(e, 0) - weight_b.get(e, 0)) for e in weight_a | weight_b)
            for places in (16, 64, 1024):
                x, y = nd.sketch(a, wa, places), nd.sketch(b, wb, places)
                assert (x.view(np.uint8) != y.view(np.uint8)).sum() <= apart
                wide = nd.sketch(a, wa, 2 * places)
                assert (wide[: len(x)] ^ wide[len(x) :] == x).all()


def test_places_are_counted_by_bytes(spark):
    rng = np.random.default_rng(5)
    rows = [(rng.integers(-(2**63), 2**63 - 1, 4), rng.integers(-(2**63), 2**63 - 1, 4)) for _ in range(20)]
    rows = [(a, np.where(rng.random(4) < 0.5, a, b)) for a, b in rows] + [(np.full(4, -1), np.zeros(4, np.int64))]
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in rows], "a array<long>, b array<long>")
    got = [r["n"] for r in df.select(nd._places(df["a"], df["b"]).alias("n")).collect()]
    assert got == [int((a.view(np.uint8) != b.view(np.uint8)).sum()) for a, b in rows]


def test_counts_as_weights(spark):
    rows = [(1, "of the " * 300 + prose(1, 20), "en", "s", 1), (2, "of the " * 300 + prose(2, 20), "en", "s", 1)]
    df = documents_df(spark, rows)
    assert {r["class_id"] for r in nd.report(df, weights="count").collect()} == {1}
    assert {r["class_id"] for r in nd.report(df).collect()} == {1, 2}


def test_components(spark):
    pairs = [(f"{i:03}", f"{i + 1:03}") for i in range(60)] + [("500", f"{i}") for i in range(501, 540)] + [("900", "900")]
    rows = components(spark.createDataFrame(pairs, "a string, b string")).collect()
    expected = {(f"{i:03}", "000") for i in range(61)} | {(f"{i}", "500") for i in range(500, 540)}
    assert {tuple(r) for r in rows} == expected
    assert len(rows) == len(expected)


def test_empty(spark):
    none = documents_df(spark, [])
    assert nd.report(none).collect() == []
    assert nd.keep_one(none).collect() == []
