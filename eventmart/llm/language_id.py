"""Hierarchical language identification: the language family first, then the language within it.

Features are hashed counts of 1 to 3 characters of the whole text, lower-cased, all that is no letter as one space. One-
versus-one linear support vector machines (squared hinge, trained in numpy) tell families apart, and within each family
those of every two of its languages decide by votes, then by margin. Learned languages that the family table does not
list are a family of their own. The score is the winner's mean pairwise confidence, family times language.

The machines are fitted on a bounded sample: ``sample`` documents in all, shared evenly by the languages, those with the
smallest hash, each id and text once; the documents' lang is read there alone. Texts are scored where they lie, without a shuffle, against
weights whose size depends on the number of languages only.

Null texts and texts without a letter are ``und`` with score 0, and so is everything if no language could be learned.
Repeated rows get a row each. Rows without lang or text teach nothing. Empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import fresh, stored

FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nb", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"],
    "indo-aryan": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "turkic": ["az", "kk", "ky", "tr", "uz"],
    "uralic": ["et", "fi", "hu"],
    "semitic": ["am", "ar", "he", "mt"],
}
SAMPLE = 4000  # documents that the machines are fitted on, at most
UNSURE = 0.005  # share of a language's held-out documents that may score less than its least score
UNKNOWN = "und"
_DIMS = 4096
_CHUNK = 1 << 20  # characters at a time
_ROWS = 512  # texts at a time
_STEPS = 10_000  # scores are counted by their ten-thousandth
_LETTER = re.compile(r"[^\W\d_]")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _counts(text: str) -> np.ndarray:
    total = np.zeros(_DIMS)
    letters = _letters()
    for at in range(0, len(text), _CHUNK):
        # Two characters of the chunk before, so that every trigram is counted once.
        back = min(at, 2)
        part = text[at - back : at + _CHUNK].lower()
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        code = np.where(letters[code], code, 32).astype(np.uint64)
        pair = code[1:] * np.uint64(0x9E3779B97F4A7C15) + code[:-1]
        triple = code[2:] * np.uint64(0xC2B2AE3D27D4EB4F) + pair[:-1]
        for skip, gram in ((back, code), (max(back - 1, 0), pair), (0, triple)):
            gram = gram[skip:]
            spread = (gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            total += np.bincount((spread >> np.uint64(52)).astype(np.int64), minlength=_DIMS)
    return total


def features(texts: list[str | None]) -> np.ndarray:
    """Per text: square roots of the features' shares, a vector of length 1; zeros where there is nothing."""
    out = np.zeros((len(texts), _DIMS), np.float32)
    for row, text in zip(out, texts, strict=True):
        if text:
            counts = _counts(text)
            row[:] = np.sqrt(counts / max(counts.sum(), 1))
    return out


def fit(x: np.ndarray, y: np.ndarray, strength: float = 1e-4, rounds: int = 200) -> np.ndarray:
    """Weights and intercept of a linear machine with squared hinge loss; ``y`` is 1 or -1, rows where it is 0 don't count."""
    known = np.flatnonzero(y)
    whole, x, y = x, np.ones((len(known), x.shape[1] + 1), np.float32), y[known]
    for at in range(0, len(known), _ROWS):
        x[at : at + _ROWS, :-1] = whole[known[at : at + _ROWS]]
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead, step = w, 1 / (2 * 2 + strength)  # rows have length sqrt(2) and shares sum to 1
    for i in range(rounds):
        lack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - step * (strength * ahead - 2 * (x.T @ (share * lack * y)))
        ahead, w = new + (i / (i + 3)) * (new - w), new
    return w


class Duel:
    """One-versus-one machines over some classes."""

    def __init__(self, names: list[str], x: np.ndarray, labels: np.ndarray):
        self.names = sorted(names)
        self.pairs = list(combinations(range(len(self.names)), 2))
        weights = []
        for a, b in self.pairs:
            first, second = labels == self.names[a], labels == self.names[b]
            weights.append(fit(x, first.astype(np.float32) - second.astype(np.float32)))
        self.weights = np.stack(weights) if weights else np.zeros((0, _DIMS + 1), np.float32)

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winner and its mean confidence."""
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        votes, sums, sure = (np.zeros((len(x), len(self.names))) for _ in range(3))
        for (a, b), m in zip(self.pairs, margins.T, strict=True):
            p = 1 / (1 + np.exp(-4.0 * m.astype(np.float64)))
            votes[:, a] += m > 0
            votes[:, b] += m <= 0
            sums[:, a] += np.tanh(m)
            sums[:, b] -= np.tanh(m)
            sure[:, a] += p
            sure[:, b] += 1 - p
        best = np.argmax(votes + sums / (2 * len(self.names)), axis=1)
        return best, sure[np.arange(len(x)), best] / max(len(self.names) - 1, 1) if self.pairs else np.ones(len(x))


class Model:
    """A machine for families and one for each family's languages."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        known = {lang: name for name, members in FAMILIES.items() for lang in members}
        family = np.array([known.get(lang, f"of {lang}") for lang in langs])
        self.families = Duel(sorted(set(family)), x, family)
        self.within = [
            Duel(sorted(set(langs[family == f])), x[family == f], langs[family == f]) for f in self.families.names
        ]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        lettered = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if not lettered or not self.within:
            return langs, scores
        x = features([texts[i] for i in lettered])
        family, sure = self.families(x)
        for f, duel in enumerate(self.within):
            mine = np.flatnonzero(family == f)
            if len(mine):
                lang, also = duel(x[mine])
                for k, name, score in zip(mine, lang, sure[mine] * also, strict=True):
                    langs[lettered[k]], scores[lettered[k]] = duel.names[name], min(max(score, 0.0), 1.0)
        return langs, scores


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def learn(documents: DataFrame, sample: int = SAMPLE) -> Model:
    """The machines, from labelled documents that are not held out."""
    taught = documents.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    hashed = taught.select("lang", F.xxhash64("doc_id", "text").alias("hash"), "text")
    n_langs = taught.select("lang").distinct().count()
    if not n_langs:
        return Model(np.zeros((0, _DIMS), np.float32), np.array([], dtype=object))
    per = min(1000, max(2, sample // n_langs))  # up to 1000 Spark keeps only so many rows a task before it shuffles
    first = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    last = (
        hashed.select("lang", "hash").distinct().withColumn("_n", first).where(F.col("_n") <= per)
        .groupBy("lang").agg(F.max("hash").alias("_last"))
    )
    chosen = hashed.join(stored(last, "languages"), "lang").where(F.col("hash") <= F.col("_last")).dropDuplicates(["lang", "hash"])

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch.iloc[at : at + _ROWS]
                x = features(part["text"].tolist()).astype(np.float16)
                packed = [zlib.compress(r.tobytes(), 1) for r in x]  # most features are 0, and all goes through the driver
                yield pd.DataFrame({"lang": part["lang"].to_numpy(), "hash": part["hash"].to_numpy(), "x": packed})

    rows = chosen.mapInPandas(vectors, "lang string, hash long, x binary").toPandas()
    rows = rows.sort_values(["lang", "hash"])
    langs = np.array(rows["lang"].tolist(), dtype=object)  # no view, which would keep the whole frame
    x = np.empty((len(rows), _DIMS), np.float16)  # half of what ``fit`` makes of it
    for row, packed in zip(x, rows["x"], strict=True):
        row[:] = np.frombuffer(zlib.decompress(packed), np.float16)
    del rows
    return Model(x, langs)


def identify(documents: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``documents`` with language and score under these names; the prediction reads nothing but the text."""
    found = fresh(documents, "found")[0]
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred string, score double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(texts.iloc[at : at + _ROWS].tolist()) for at in range(0, len(texts), _ROWS)]
        return pd.DataFrame({
            "lang_pred": [lang for langs, _ in found for lang in langs],
            "score": np.concatenate([scores for _, scores in found]) if found else np.zeros(0),
        })

    return (
        documents.withColumn(found, predict("text"))
        .withColumn(names[0], F.col(found)["lang_pred"])
        .withColumn(names[1], F.col(found)["score"])
        .drop(found)
    )


def least_scores(documents: DataFrame, model: Model, unsure: float = UNSURE) -> dict[str, float]:
    """Per language: a score that all but ``unsure`` of its rightly predicted held-out documents reach.

    All held-out documents are scored, and counted by their score's ten-thousandth, so that a language is so many rows at
    most. A language with fewer than 1 / ``unsure`` of them has no such score and is left out.
    """
    held = documents.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & held_out(F.col("doc_id")))
    steps = identify(held.select("lang", "text"), model).groupBy("lang", F.floor(F.col("score") * _STEPS).alias("step"))
    # Spark would move a filter on lang_pred below the prediction, with a prediction of its own in a worker of its own.
    counted = steps.agg(F.count_if(F.col("lang") == F.col("lang_pred")).alias("n")).where("n > 0")
    by_lang: dict[str, list[tuple[int, int]]] = {}
    for lang, step, n in counted.collect():
        by_lang.setdefault(lang, []).append((step, n))
    least = {}
    for lang, steps in by_lang.items():
        below = int(unsure * sum(n for _, n in steps))
        if below:
            for step, n in sorted(steps):
                below -= n
                if below < 0:
                    least[lang] = max(step - 1, 0) / _STEPS
                    break
    return least
