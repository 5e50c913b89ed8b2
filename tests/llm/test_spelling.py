"""Spelling variants against a comparison of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from eventmart.llm import spelling
from tests.llm.rows import DOCUMENT, documents, documents_df, prose


def damaged(run: str, doc_id) -> str:
    lowered = "".join(c.lower() if c.isascii() else c for c in run)
    number = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{lowered}".encode())
    place = number % len(run)
    return lowered if number % 199 else lowered[:place] + lowered[place + 1:]


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts: dict[str, int]) -> dict[str, tuple]:
    forms, rows = {}, {}
    for word, n in counts.items():
        others = [o for o in counts if near(word, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form = best if best is not None and counts[best] >= 5 * n else None
        forms[word] = form
        rows[word] = n, len(others), form, counts[form] if form else None
    for word in counts:
        root = word
        while forms[root]:
            root = forms[root]
        rows[word] = rows[word][:3] + (root, rows[word][3])
    return rows


def found(frame) -> dict[str, tuple]:
    rows = [tuple(r) for r in frame.select("word", "n", "n_near", "form", "root", "form_n").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def words_of(rows) -> dict[str, int]:
    counts = Counter()
    for doc_id, text, *_ in rows:
        counts.update(damaged(run, doc_id) for run in re.findall("[A-Za-zÀ-ÿ]+", text or "") if len(run) >= 6)
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_awkward_documents(spark):
    rows = documents() + [(7, "Über" + "lang" * 3000 + " ÜBERGANG übergang übergan×g", "de", None, None)] * 6
    rows += [(200 + i, (prose(500 + i % 9, 40) + " ") * (1 + i % 5), "en", None, None) for i in range(60)]
    rows += [(300, "cafétéria " * 100 + "cafetéria " * 20 + "caféteria " * 21 + "cafetería " * 6, "fr", None, None)]
    wanted = plain(words_of(rows))
    assert len(wanted) > 100 and any(v[2] for v in wanted.values())
    assert found(spelling.report(documents_df(spark, rows))) == wanted


@pytest.mark.parametrize("letters", [12, 60, 1 << 15])
def test_files_cut_into_grids(spark, letters):
    """Words over two letters, so that files are large against the bound and all kinds of neighbours occur."""
    r = random.Random(5)
    counts = {"".join(r.choices("aé", k=r.randint(6, 9))): r.choice([5, 5, 30, 160, 900]) for _ in range(150)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(spelling.variants(frame, letters=letters)) == plain(counts)


def test_forms_are_followed_to_the_last(spark):
    chain = {"aaaaaa": 5, "aaaaaab": 25, "aaaaabb": 125, "aaaabbb": 625, "aaabbbb": 3125, "aabbbbb": 15625}
    rows = found(spelling.variants(spark.createDataFrame(list(chain.items()), "word string, n long")))
    assert {row[3] for row in rows.values()} == {"aabbbbb"}
    assert rows["aaaaaa"][2] == "aaaaaab" and rows["aabbbbb"][2] is None


def test_ties_go_to_the_smaller_word_and_repeated_rows_count(spark):
    text = "letters " * 5 + "lettera " * 25 + "letterz " * 25
    one = found(spelling.report(documents_df(spark, [(1, text, None, None, None)])))
    twice = found(spelling.report(documents_df(spark, [(1, text, None, None, None)] * 2, clashing=True)))
    assert one["letters"][2] == "lettera" and one["lettera"][2] is None
    assert {w: row[0] for w, row in twice.items()} == {w: 2 * row[0] for w, row in one.items()}


def test_no_words(spark):
    assert spelling.report(spark.createDataFrame([], DOCUMENT)).collect() == []
    assert spelling.report(documents_df(spark, [(1, None, None, None, None), (2, "", None, None, 0)])).collect() == []
