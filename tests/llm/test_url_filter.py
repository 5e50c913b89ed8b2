"""URL filters: rules, the model against a plain one, calibration, awkward rows."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from eventmart.llm import url_filter
from eventmart.llm.common import stored

PAGE = "page_id long, url string, html string"
LONG = "https://blog.example.org/de/" + "Ünï/" * 20_000


def pages(spark, urls, **more):
    frame = spark.createDataFrame([(i, url, None) for i, url in enumerate(urls)], PAGE)
    return frame.withColumns(more) if more else frame


def judged(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0] is not None, r[0]))


RULED = [
    ("http://Shop.COM/a?q#x", "shop.com", "/a", "com/", "allow"),
    ("http://com/", "com", "/", "com/", "allow"),
    ("https://example.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
    ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/1", "a.www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://myexample.com/en/1", "myexample.com", "/en/1", "com/", "allow"),
    ("https://x.net/es/", "x.net", "/es/", "net/es/", "block"),
    ("https://x.net/fr/1#b?c", "x.net", "/fr/1", "net/fr/", "block"),
    ("https://x.net/ES/", "x.net", "/ES/", None, None),
    ("https://x.com", "x.com", "", None, None),
    ("https://x.com?u=http://y.net/es/", "x.com", "", None, None),
    ("https://x.com:80/", "x.com:80", "/", None, None),
    ("a\nb://É.net/es/\n", "É.net", "/es/\n", "net/es/", "block"),
    ("mailto:someone", "", "", None, None),
    ("://", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_rules(spark):
    out = judged(url_filter.judge(pages(spark, [url for url, *_ in RULED])))
    assert [row[1:4] for row in out] == [(host, path, rule) for _, host, path, rule, _ in RULED]
    for row, (*_, verdict) in zip(out, RULED):
        assert row[4] == verdict if verdict else row[4] in ("allow", "block")


def shares(texts, order):
    """Witten-Bell shares of a letter after its context, computed plainly."""
    follow = defaultdict(Counter)
    for text in texts:
        padded = "\x02" * order + text + "\x03"
        for i in range(order, len(padded)):
            for k in range(order + 1):
                follow[padded[i - k:i]][padded[i]] += 1
    return follow


def share(follow, letters, context, letter):
    shorter = share(follow, letters, context[1:], letter) if context else 1 / letters
    seen = follow.get(context)
    return (seen[letter] + len(seen) * shorter) / (sum(seen.values()) + len(seen)) if seen else shorter


@pytest.mark.parametrize("order", [1, 4])
def test_scores_against_a_plain_model(spark, order):
    good = ["shop.com/a", "shop.com/ab", "näh.com/", ""]
    bad = ["spam.net/es/1", "spam.net/es/22"]
    rows = [(g, True) for g in good] + [(b, False) for b in bad]
    grams, contexts = url_filter.learn(spark.createDataFrame(rows, "text string, accepted boolean"), order)
    asked = ["shop.net/a", "", "ζ漢😀", "spam.com/es/1" * 50]
    frame = stored(spark.createDataFrame(list(enumerate(asked)), "id long, text string"), "asked")
    scores = dict(map(tuple, url_filter.score(frame, grams, contexts, order).collect()))
    yes, no = shares(good, order), shares(bad, order)
    letters = len({c for t in good + bad for c in t + "\x03"}) + 1
    for number, text in enumerate(asked):
        padded = "\x02" * order + text + "\x03"
        ratios = [
            round(1e6 * math.log(share(yes, letters, padded[i - order:i], padded[i]) / share(no, letters, padded[i - order:i], padded[i])))
            for i in range(order, len(padded))
        ]
        assert scores[number] == pytest.approx(sum(ratios) / len(ratios), abs=1)


def test_threshold(spark):
    def least(rows):
        return url_filter.threshold(spark.createDataFrame(rows, "score double, accepted boolean"))

    assert least([(-5000.0, False), (-2000.0, False), (4000.0, True), (9000.0, True)]) == 1500.0
    assert least([(1000.0, False), (2000.0, True), (3000.0, False), (4000.0, True), (5000.0, True)]) in (2000.0, 4000.0)
    assert least([(1000.0, True)]) == least([(1000.0, False)]) == 0.0


def test_hidden_labels_are_found(spark):
    """Addresses without a rule go with those that look like them; a repeated url and an extra column change nothing."""
    urls = [f"https://shop{i}.com/de/{i}" for i in range(60)] + [f"https://spam{i}.net/es/{i}" for i in range(60)]
    asked = [f"https://shop{i}.org/de/{i}" for i in range(100, 110)] + [f"https://spam{i}.org/es/{i}" for i in range(100, 110)]
    frame = pages(spark, urls + asked + [asked[-1]] * 100 + [LONG, None, "", "no address"])
    verdicts = {row.page_id: row.verdict for row in url_filter.judge(frame.withColumn("verdict", frame["url"])).collect()}
    assert len(verdicts) == frame.count()
    assert [verdicts[i] for i in range(120, 140)] == ["allow"] * 10 + ["block"] * 10
    assert {verdicts[i] for i in range(140, 240)} == {"block"}


def test_repeated_rows_and_nulls_are_each_returned(spark):
    rows = [(None, None, None)] * 3 + [(1, "http://a.org/", "x")] * 2
    out = judged(url_filter.judge(spark.createDataFrame(rows, PAGE)))
    assert [r[:4] for r in out] == [(None, "", "", None)] * 3 + [(1, "a.org", "/", None)] * 2
    assert len({r[4] for r in out}) == 1


def test_empty(spark):
    out = url_filter.judge(spark.createDataFrame([], PAGE))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"] and out.collect() == []


def test_no_python_in_the_plan(spark):
    plan = url_filter.judge(pages(spark, ["http://a.com/", "http://b.org/"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
