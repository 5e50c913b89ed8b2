from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from eventmart.llm import quality
from tests.llm.rows import documents, documents_df, prose

LABEL = "doc_id long, quality int, toxic int"
TEXTS = [prose(i, 40) for i in range(12)] + ["aaa bbb", "ééé 漢字 😀"]


class Brute:
    """The same model, from its definition."""

    def __init__(self, texts):
        n = quality.ORDER
        counts = {n: Counter()}
        for t in texts:
            padded = "\x02" * (n - 1) + t
            counts[n].update(padded[i : i + n] for i in range(len(t)))
        for k in range(n - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        self.counts = counts
        self.off, self.context = {}, defaultdict(lambda: [0, 0.0])
        for k, c in counts.items():
            of = Counter(c.values())
            y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0
            self.off[k] = [
                (min(max(i - (i + 1) * y * of[i + 1] / of[i] if of[i] else 0.5 * i, 0.1), i - 0.1) if of[1] else 0.5) for i in (1, 2, 3)
            ]
            for g, m in c.items():
                entry = self.context[(k, g[:-1])]
                entry[0] += m
                entry[1] += self.off[k][min(m, 3) - 1]

    def p(self, g):
        if not g:
            return 1 / (len(self.counts[1]) + 1)
        lower = self.p(g[1:])
        if (len(g), g[:-1]) not in self.context:
            return lower
        total, off = self.context[(len(g), g[:-1])]
        m = self.counts[len(g)][g]
        return (m - self.off[len(g)][min(m, 3) - 1] if m else 0) / total + off / total * lower

    def perplexity(self, text):
        padded = "\x02" * (quality.ORDER - 1) + text
        logs = [math.log(self.p(padded[i : i + quality.ORDER])) for i in range(len(text))]
        return math.exp(-sum(logs) / len(text))


@pytest.mark.parametrize("rows_a_shard", [1_000_000, 900])
def test_perplexities_against_the_definition(spark, monkeypatch, rows_a_shard):
    monkeypatch.setattr(quality, "_SHARD_ROWS", rows_a_shard)
    monkeypatch.setattr(quality, "_PLACES", 100)
    df = documents_df(spark, [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)])
    asked = [*TEXTS[:3], prose(77, 80), "ZZZ!!! ###", "漢", "漢"]
    model = quality.train(df)
    rows = quality.perplexities(documents_df(spark, [(i, t, "en", "s", 1) for i, t in enumerate(asked)]), model).collect()
    brute = Brute(TEXTS)
    assert len(rows) == len(asked)
    for r in rows:
        assert r["perplexity"] == pytest.approx(brute.perplexity(asked[r["doc_id"]]), rel=1e-9)


def test_probabilities_sum_to_one():
    brute = Brute(TEXTS)
    seen = list(brute.counts[1])
    for context in ("", "t", "th", "\x02\x02\x02\x02", "zzzz", TEXTS[0][:4]):
        assert sum(brute.p(context + c) for c in seen) + brute.p(context + "\x00") == pytest.approx(1)


def test_noise_is_found_and_awkward_rows_have_results(spark):
    clean = [(1000 + i, prose(500 + i, 60), "en", "s", 1) for i in range(200)]
    noise = [(2000 + i, "".join(chr(33 + (i * 7 + j * 13) % 15) for j in range(200)), "en", "s", 1) for i in range(10)]
    docs = documents() + clean + noise
    labels = [(i, 1, 0) for i, *_ in clean[:150]] + [(2000, 0, 0), (1, 1, 0), (None, 1, 0), (1000, 1, 0), (3, None, None)]
    rows = quality.classify(documents_df(spark, docs, clashing=True), spark.createDataFrame(labels, LABEL)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d[0] for d in docs)
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert not any(kept[i] for i, *_ in noise)
    assert sum(kept[i] for i, *_ in clean) >= 190
    assert not kept[1] and not kept[2]
    assert kept[13]  # no trusted text of its language


def test_empty(spark):
    none, labels = documents_df(spark, []), spark.createDataFrame([], LABEL)
    assert quality.classify(none, labels).collect() == []
    assert all(r["kept"] == bool(r["perplexity"] is None and r["doc_id"] not in (1, 2, None)) or r["doc_id"] is None
               for r in quality.classify(documents_df(spark), labels).collect())
