from __future__ import annotations

import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventmart.llm import personal_data as pd_
from tests.llm.rows import documents, documents_df

_PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t, d: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t, d: all(int(p) <= 255 for p in t.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda t, d: 14 <= len(d) <= 19 and pd_.luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t, d: 10 <= len(d) <= 15),
}


def _brute(text):
    found = [
        (kind, *m.span()) for kind, (pattern, good) in _PATTERNS.items()
        for m in re.finditer(pattern, text) if good(m[0], re.sub("[^0-9]", "", m[0]))
    ]
    return sorted(found, key=lambda s: (s[1], pd_.KINDS.index(s[0])))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="aB01234567890..@@+-- ()_%é\n", max_size=70))
def test_base_spans_are_those_of_the_patterns(text):
    assert pd_.base_spans(text) == _brute(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["4111111111111111", "4111 1111 1111 1111", " ", "-", "1", "+1 (212) 555-0100", "10.0.0.1", ".", "a@b.co", "x"]), max_size=8).map("".join))
def test_base_spans_of_likely_texts(text):
    assert pd_.base_spans(text) == _brute(text)


def test_long_texts_take_linear_time():
    begin = time.perf_counter()
    pd_.base_spans("a" * 1_000_000 + "@" + "1" * 1_000_000 + "+1" * 50_000 + "1." * 500_000 + "@" * 100_000)
    assert time.perf_counter() - begin < 60


@pytest.fixture(scope="module")
def field(spark):
    rows = [(i, f"call +1 (212) 555-{i:04d} or mail me{i}@mail.example.com from 10.0.{i}.7", "en", "s", 1) for i in range(60)]
    return pd_.learn(documents_df(spark, rows + documents()))


def test_the_field_adds_spans_and_keeps_base_ones(spark, field):
    text = "😀 mail a.b@example.com or call (212) 555-0199 before 9"
    df = documents_df(spark, [*documents(), (300, text, "en", "s", 1)], clashing=True)
    rows = {r["doc_id"]: r for r in pd_.find(df, field).collect()}
    spans = [tuple(s) for s in rows[300]["spans"]]
    assert ("email", text.index("a.b"), text.index(" or")) in spans
    assert ("phone", text.index("(212"), text.index(" before")) in spans
    assert [tuple(s) for s in rows[300]["base_spans"]] == _brute(text)
    assert pd_.mask(text, spans) == "😀 mail [email] or call [phone] before 9"
    assert rows[1]["spans"] == rows[2]["spans"] == rows[9]["spans"] == []
    assert all(not rows[i]["spans"] for i in range(40, 60))


def test_report(spark, field):
    r = pd_.report(documents_df(spark, [(1, "10.0.0.1, 4111111111111111", "en", "s", 1), (2, None, None, None, None)]), field).collect()
    by_id = {x["doc_id"]: x for x in r}
    assert (by_id[1]["n_email"], by_id[1]["n_ip"], by_id[1]["n_card"], by_id[1]["n_phone"]) == (0, 1, 1, 0)
    assert by_id[1]["spans"] == "ip:0:8,card:10:26"
    assert by_id[2]["spans"] == ""


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    field = pd_.Field()
    field.weights, field.steps = rng.normal(size=field.weights.shape), rng.normal(size=field.steps.shape)
    runs = [[[int(f)] for f in rng.integers(0, 2048, n)] for n in (1, 2, 3, 3)]
    step = field.steps + field.allowed
    for run, states in zip(runs, field.decode(runs), strict=True):
        scores = field.weights[[f[0] for f in run]]

        def total(path, scores=scores):
            return field.first[path[0]] + sum(scores[t, s] for t, s in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:]))

        paths = np.stack(np.meshgrid(*[range(9)] * len(run), indexing="ij"), -1).reshape(-1, len(run))
        assert total(list(states)) == pytest.approx(max(total(list(p)) for p in paths))


def test_empty(spark):
    none = documents_df(spark, [])
    assert pd_.report(none, pd_.learn(none)).collect() == []
