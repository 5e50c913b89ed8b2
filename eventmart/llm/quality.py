"""Text quality by an interpolated modified Kneser-Ney model of characters, trained on trusted text.

Counts of the trusted texts' character 5-grams, per language, are summed over all of them, and every lower order is
counted by continuation. Discounts, context totals and probabilities are joins of these count tables on
(language, context) and (language, suffix), which shuffle by key. A text's perplexity needs the probability of the longest
gram known at each place and the weights of the longer contexts: the model is cut into shards by the two characters before
the predicted one, so that all that a place needs is in one shard; a shard of at most ``_SHARD_ROWS`` rows or so is sent to
the tasks, which join it with the grams of whole texts by sorted keys, one pass over the texts per shard. (Joining
by a shuffle would move a row per character.) Everything grows with the trusted text; nothing is sampled or cut.

A document is kept if its perplexity is at most a quantile of that of its language's trusted documents. One trusted document in five, by hash, is kept from training, and the quantile is that
of these documents, which the model knows no better than any other. Languages without them have no quantile, and
their documents are kept.

Null and empty texts have no perplexity and are not kept. A null lang is a language. Repeated rows get a row each. Empty tables
give empty results; without labels everything with a text is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import small_enough, stored

ORDER = 5
QUANTILE = 0.99
_PARTS = 5  # of the trusted documents; one of them sets the threshold
_START = "\x02"  # before a text
_SHARD_ROWS = 1_500_000  # 24 bytes each
_BROADCAST_IDS = 4_000_000
_PLACES = 1 << 20  # characters scored together
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _lang(df: DataFrame) -> DataFrame:
    return df.withColumn("lang", F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("null")))


def _codes(text: str) -> np.ndarray:
    padded = _START * (ORDER - 1) + text
    return np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _keys(codes: np.ndarray, n: int) -> np.ndarray:
    """A number for the ``n`` characters that end at each place from the ORDERth on."""
    key = np.full(len(codes) - ORDER + 1, n, np.uint64)
    for i in range(ORDER - n, ORDER):
        key = (key + codes[i : len(codes) - ORDER + 1 + i]) * _ODD
        key ^= key >> np.uint64(32)
    return key


# --- training ------------------------------------------------------------------------------------


def trusted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents of good quality that are not toxic."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 AND t = 0")
    ids = stored(good.select("doc_id"), "trusted")
    return documents.join(small_enough(ids, _BROADCAST_IDS), "doc_id", "left_semi")


def grams(texts: DataFrame) -> DataFrame:
    """Counts of all grams of the highest order: lang, gram, c."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                for at in range(0, len(rows), 256):
                    many = [t for t in rows["text"].iloc[at : at + 256] if t]
                    if not many:
                        continue
                    keys = np.concatenate([_keys(_codes(t), ORDER) for t in many])
                    _, first, count = np.unique(keys, return_index=True, return_counts=True)
                    whole = (_START * (ORDER - 1)).join(["", *many])
                    # Places of the texts' characters in the whole, which has padding before each text.
                    ends = np.concatenate([
                        np.arange(len(t)) + begin for t, begin in zip(many, _begins(many), strict=True)
                    ])[first]
                    yield pd.DataFrame({"lang": lang, "gram": [whole[e - ORDER + 1 : e + 1] for e in ends], "c": count})

    counted = _lang(texts).select("lang", "text").mapInPandas(run, "lang string, gram string, c long")
    return counted.groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def _begins(texts: list[str]) -> list[int]:
    begins, at = [], 0
    for t in texts:
        at += ORDER - 1
        begins.append(at)
        at += len(t)
    return begins


def _discounts(counts: DataFrame) -> DataFrame:
    """Per language: what is taken off counts of 1, 2, and 3 or more."""
    n = {k: F.sum((F.col("c") == k).cast("double")) for k in (1, 2, 3, 4)}
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    sums = counts.groupBy("lang").agg(*(e.alias(f"n{k}") for k, e in n.items()))

    def off(k: int):
        ratio = F.when(F.col(f"n{k}") > 0, k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"))
        return F.least(F.greatest(F.coalesce(ratio, F.lit(0.5 * k)), F.lit(0.1)), F.lit(k - 0.1)).alias(f"d{k}")

    return sums.where("n1 > 0").select("lang", *map(off, (1, 2, 3))).unionByName(
        sums.where("n1 = 0").select("lang", *(F.lit(0.5).alias(f"d{k}") for k in (1, 2, 3)))
    )


def train(texts: DataFrame) -> DataFrame:
    """The model: lang, n, gram, logp of grams, and logw of contexts (weight of the next lower order)."""
    counts = {ORDER: stored(grams(texts), "grams")}
    for n in range(ORDER - 1, 0, -1):
        longer = counts[n + 1].select("lang", F.substring("gram", 2, n).alias("gram"))
        counts[n] = stored(longer.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c")), "grams")
    lower = counts[1].groupBy("lang").agg((1 / (F.count(F.lit(1)) + 1)).alias("p")).withColumn("gram", F.lit(""))
    parts = [lower.select("lang", F.lit(0).alias("n"), "gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("logw"))]
    for n in range(1, ORDER + 1):
        taken = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        known = (
            counts[n].join(_discounts(counts[n]), "lang").withColumn("off", taken)
            .withColumn("context", F.substring("gram", 1, n - 1)).withColumn("suffix", F.substring("gram", 2, n - 1))
        )
        contexts = known.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("off").alias("left"))
        contexts = stored(contexts.withColumn("w", F.col("left") / F.col("total")), "contexts")
        shorter = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
        here = known.join(contexts, ["lang", "context"]).join(shorter, ["lang", "suffix"]).select(
            "lang", "gram", ((F.col("c") - F.col("off")) / F.col("total") + F.col("w") * F.col("lower")).alias("p")
        )
        lower = stored(here, "probabilities")
        parts.append(lower.select("lang", F.lit(n).alias("n"), "gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("logw")))
        parts.append(contexts.select(
            "lang", F.lit(n - 1).alias("n"), F.col("context").alias("gram"), F.lit(None).cast("double").alias("logp"), F.log("w").alias("logw")
        ))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# --- scoring -------------------------------------------------------------------------------------


class _Sorted:
    """Values by key, found by the key's leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = np.append(keys[order], np.uint64(2**64 - 1)), np.append(values[order], np.nan)
        self.bits = max(1, min(22, int(len(keys)).bit_length()))
        starts = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.starts = np.searchsorted(self.keys, starts)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """The values; nan where there is none."""
        at = self.starts[(wanted >> np.uint64(64 - self.bits)).astype(np.int64)]
        behind = np.flatnonzero(self.keys[at] < wanted)
        while len(behind):
            at[behind] += 1
            behind = behind[self.keys[at[behind]] < wanted[behind]]
        return np.where(self.keys[at] == wanted, self.values[at], np.nan)


def _gram_codes(grams: list[str], n: int) -> np.ndarray:
    return np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64).reshape(-1, n)


def _gram_keys(codes: np.ndarray) -> np.ndarray:
    """As ``_keys``, of grams given a row each."""
    key = np.full(len(codes), codes.shape[1], np.uint64)
    for i in range(codes.shape[1]):
        key = (key + codes[:, i]) * _ODD
        key ^= key >> np.uint64(32)
    return key


def numbered(model: DataFrame, shards: int) -> DataFrame:
    """The model as numbers: shard (-1: in all), weight (of a context) or not, n, key, value."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (n, weight), rows in batch.groupby(["n", "weight"]):
                codes = _gram_codes(rows["gram"].tolist(), n) if n else np.zeros((len(rows), 0), np.uint64)
                pair = codes[:, -2:] if weight else codes[:, -3:-1]
                shard = _pair_shard(pair[:, 0], pair[:, 1], shards) if pair.shape[1] == 2 else -1
                key = _mixed(_gram_keys(codes) ^ rows["salt"].to_numpy(np.int64).view(np.uint64)).view(np.int64)
                yield pd.DataFrame({"shard": shard, "weight": weight, "n": n, "key": key, "value": rows["value"].to_numpy()})

    rows = model.select(
        F.col("logw").isNotNull().alias("weight"), "n", "gram", F.xxhash64("lang").alias("salt"),
        F.coalesce("logp", "logw").alias("value"),
    )
    return rows.mapInPandas(run, "shard int, weight boolean, n int, key long, value double")


def _pair_shard(a: np.ndarray, b: np.ndarray, shards: int) -> np.ndarray:
    return (_mixed(a * _ODD + b) % np.uint64(shards)).astype(np.int64)


class Shard:
    """A part of the model, to be joined with the grams of texts."""

    def __init__(self, rows: pa.Table, number: int, shards: int):
        self.number, self.shards = number, shards
        weight, n, key, value = (rows.column(c).to_numpy() for c in ("weight", "n", "key", "value"))
        self.grams, self.weights = {}, {}
        for is_weight, out in ((False, self.grams), (True, self.weights)):
            for size in np.unique(n[weight == is_weight]):
                mine = (weight == is_weight) & (n == size)
                out[int(size)] = _Sorted(key[mine].view(np.uint64), value[mine])

    def score(self, text: str, salt: int) -> tuple[float, int]:
        """Sum of the logarithms of the probabilities of this shard's places of a text, and their number."""
        total, places = 0.0, 0
        for at in range(0, len(text), _PLACES):
            begin = max(0, at - ORDER + 1)
            codes = _codes(text[begin : at + _PLACES])[at - begin :]  # the chunk's places, and what is before them
            if self.shards > 1:
                before = codes[ORDER - 3 : -2], codes[ORDER - 2 : -1]
                mine = np.flatnonzero(_pair_shard(*before, self.shards) == self.number)
            else:
                mine = np.arange(len(codes) - ORDER + 1)
            some, left = self._sum(codes, mine, np.uint64(salt & 0xFFFFFFFFFFFFFFFF))
            total += some
            places += len(mine) - left
        return total, places

    def _sum(self, codes: np.ndarray, places: np.ndarray, salt: np.uint64) -> tuple[float, int]:
        """The sum, and the number of places without any probability (of an unknown language)."""
        total = 0.0
        before = np.concatenate([codes[:1], codes[:-1]])
        for n in range(ORDER, -1, -1):
            if len(places) and n in self.grams:
                logp = self.grams[n](_mixed(_keys(codes, n)[places] ^ salt))
                known = ~np.isnan(logp)
                total += logp[known].sum()
                places = places[~known]
            if len(places) and n and n - 1 in self.weights:
                # The context is the gram's first n - 1 characters: those that end one place earlier.
                total += np.nansum(self.weights[n - 1](_mixed(_keys(before, n - 1)[places] ^ salt)))
        return float(total), len(places)


def _shards(model: DataFrame) -> Iterator[Shard]:
    shards = max(1, math.ceil(model.count() / _SHARD_ROWS))
    cut = stored(numbered(model, shards), "shards")
    for i in range(shards):
        yield Shard(cut.where(F.col("shard").isin(i, -1)).drop("shard").toArrow(), i, shards)


def perplexities(documents: DataFrame, model: DataFrame) -> DataFrame:
    """Per document with a text: doc_id, lang (marked), perplexity (null without a model of its language)."""
    texts = _lang(documents.where("length(text) > 0").select("doc_id", "lang", "text"))
    rows = texts.select("doc_id", "lang", F.xxhash64("text").alias("h"), F.xxhash64("lang").alias("salt"), "text")
    parts = []
    for shard in _shards(model):
        shared = documents.sparkSession.sparkContext.broadcast(shard)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                scored = [shared.value.score(t, salt) for t, salt in zip(batch["text"], batch["salt"], strict=True)]
                out = batch[["doc_id", "lang", "h"]].copy()
                out["total"], out["places"] = [s for s, _ in scored], [n for _, n in scored]
                yield out

        parts.append(stored(rows.mapInPandas(run, "doc_id long, lang string, h long, total double, places long"), "scores"))
        shared.unpersist()
    scored = parts[0]
    if len(parts) > 1:  # a text's places are shared out among the shards; equal rows have equal sums
        for part in parts[1:]:
            scored = scored.unionByName(part)
        n_rows = (F.count(F.lit(1)) / len(parts)).cast("int").alias("rows")
        sums = F.sum("total").alias("total"), F.sum("places").alias("places")
        scored = scored.groupBy("doc_id", "lang", "h").agg(*sums, n_rows)
        scored = scored.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    per_place = F.when(F.col("places") > 0, F.col("total") / F.col("places"))
    return scored.select("doc_id", "lang", F.exp(-per_place).alias("perplexity"))


def classify(documents: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Per document: doc_id, perplexity, kept."""
    sure = trusted(documents, labels)
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS)) == 0
    model = stored(train(sure.where(~apart)), "model")
    scored = stored(perplexities(documents, model), "perplexities")
    cuts = (
        trusted(scored.where(apart), labels).groupBy("lang")
        .agg(F.percentile_approx("perplexity", quantile, 100_000).alias("most"))
    )
    judged = scored.join(cuts, "lang", "left").select(
        "doc_id", "perplexity",
        F.coalesce(F.col("perplexity") <= F.col("most"), F.lit(True)).alias("kept"),
    )
    blank = documents.where("text IS NULL OR text = ''").select(
        "doc_id", F.lit(None).cast("double").alias("perplexity"), F.lit(False).alias("kept")
    )
    return judged.unionByName(blank)
