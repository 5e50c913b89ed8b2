"""Documents with the awkward cases: nulls in every column, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "item_id long, text string"

_SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti"]


def prose(seed: int, n: int) -> str:
    """``n`` invented words."""
    r = random.Random(seed)
    return " ".join("".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(n))


def documents() -> list[tuple]:
    """Awkward documents; ids 40 to 59 are plain prose."""
    long = prose(1, 30_000)
    copy = prose(2, 120)
    near = copy.replace(copy.split()[60], "different", 1)
    rows = [
        (None, prose(3, 50), "en", "src1", 1),
        (1, None, "en", "src1", None),
        (2, "", "de", None, 0),
        (3, "   \n\n ", None, "src2", 6),
        (4, long, "en", "src1", len(long)),
        (5, copy, "en", "src2", 9),
        (6, copy, "en", "src3", 9),
        (7, near, "fr", "src3", 9),
        (8, copy.upper(), None, None, 9),
        (9, "!!! ??? ...", "en", "src1", 3),
        (10, "!!! ??? ...", "en", "src1", 3),
        (11, "two words", "en", "src1", 3),
        (12, "two words", "en", "src1", 3),
        (12, "two words", "en", "src1", 3),
        (13, "één naïve 漢字 😀 ñandú", "es", "src4", 3),
        (None, None, None, None, None),
        (None, None, None, None, None),
    ]
    rows += [(40 + i, prose(100 + i, 60), "en", "src5", 1) for i in range(20)]
    return rows


def documents_df(spark, rows=None, clashing=False):
    """A DataFrame of documents; with columns named like what operators add, where asked for."""
    df = spark.createDataFrame(documents() if rows is None else rows, DOCUMENT)
    if clashing:
        for name in ("score", "lang_pred", "key", "node", "site", "kept", "found", "n_lines", "shard_", "_key", "repeated"):
            df = df.selectExpr("*", f"concat('{name}', doc_id) AS `{name}`")
    return df
