"""Spelling variants by a bit-sliced position index.

Words one inserted, deleted or replaced letter apart share either the first half of the shorter word or the rest of it, so a
word is filed under both, once as the shorter or equal word of a pair and once as the longer. Files of bounded total length
share a task's group, and a larger file is cut into a grid of groups, so no file is too large. Within a group each
(position, letter) has a bitset over the group's words. The letters of a word are read once: bitsets of the words without an error
so far, with one letter replaced and with one letter more (read one position further on) advance for all words of the group at
the same time. Only one row per word and group leaves it, not pairs: how many near words there are, and the most frequent one.

Null texts have no words, a null id counts as the text ``null``. Letters outside the range are between words. Ties go to the
smaller word in code-point order. Repeated rows count each. Texts and words may be of any length: what a group holds is bounded by
letters, not by words. Empty tables give empty results. Of the documents only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import lower_ascii, stored

# The letters of words, and every how many-th hash loses a letter.
_NOT_LETTERS = r"[^A-Za-zÀ-ÿ]+"
_DAMAGED = 199

MIN_LENGTH = 6
MIN_COUNT = 5
#: A form occurs this many times as often as its variant.
RATIO = 5
#: Letters that a group holds, on average; a file of words that has more is cut.
GROUP_LETTERS = 1 << 15

_PARTIAL = "word string, near long, best_n long, best string"


def damaged(run: Column, doc_id: Column) -> Column:
    """The run in lower case, without one of its letters where the hash of document and run says so."""
    lowered = lower_ascii(run)
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), lowered)
    # A lambda computes hash and length once per run.
    parts = F.transform(
        F.array(F.struct(lowered.alias("run"), F.crc32(key).alias("hash"), F.char_length(run).alias("length"))),
        lambda p: F.when(p["hash"] % _DAMAGED != 0, p["run"]).otherwise(_without(p["run"], p["hash"] % p["length"], p["length"])),
    )
    return F.get(parts, F.lit(0))


def _without(text: Column, place: Column, length: Column) -> Column:
    place = place.cast("int")
    return F.concat(F.substring(text, F.lit(1), place), F.substring(text, place + 2, length))


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Words of all documents that are long and frequent enough, and how often they occur: word, n."""
    runs = docs.select("doc_id", F.explode(F.split("text", _NOT_LETTERS)).alias("run"))
    return (
        runs.where(F.char_length("run") >= min_length)
        .select(damaged(F.col("run"), F.col("doc_id")).alias("word"))
        .where(F.char_length("word") >= min_length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_count)
    )


def _filed(words: DataFrame) -> DataFrame:
    """Each word under the first half and under the rest of a shorter word's length: its own, and one less.

    ``shorter`` is the length of the shorter word of the pairs that a file is for. One replaced letter leaves one of the
    two parts as it is, and so does a letter more or less.
    """
    length = F.char_length("word")
    half, rest = F.floor(F.col("shorter") / 2).cast("int"), F.ceil(F.col("shorter") / 2).cast("int")
    sides = F.array(
        F.struct(F.lit("start").alias("side"), F.substring("word", F.lit(1), half).alias("part")),
        F.struct(F.lit("end").alias("side"), F.substring(F.col("word"), length - rest + 1, rest).alias("part")),
    )
    return (
        words.withColumn("shorter", F.explode(F.array(length, length - 1)))
        .where(F.col("shorter") >= 2)
        .select("word", "n", "shorter", F.inline(sides))
    )


def _grouped(filed: DataFrame, letters: int) -> DataFrame:
    """Rows (group, row, column, word, ...): what each group reads as its index, its queries or both.

    Files up to ``letters`` share groups by hash. A larger one is cut into a grid: words are dealt to parts by
    hash, and cell (i, j) asks the words of part j against the index of part i.
    """
    file = ["shorter", "side", "part"]
    sizes = filed.groupBy(*file).agg(F.sum(F.char_length("word")).alias("letters"))
    sizes = stored(sizes.where("letters > 0"), "spelling-files")
    total = sizes.agg(F.sum("letters")).head()[0] or 0
    groups = max(1, -(-total // letters))
    large = sizes.where(F.col("letters") > letters).withColumn("parts", F.ceil(F.col("letters") / letters).cast("int"))
    cut = filed.join(large.drop("letters"), file, "left")
    small = cut.where("parts IS NULL").select(
        F.pmod(F.xxhash64(*file), F.lit(groups)).alias("group"), F.lit(0).alias("i"), F.lit(0).alias("j"),
        F.lit(True).alias("indexed"), (F.col("shorter") == F.char_length("word")).alias("asks"), "word", "n", *file,
    )
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    grid = cut.where("parts IS NOT NULL").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    cells = F.array(
        F.struct(F.col("own").alias("i"), F.col("other").alias("j"), F.lit(True).alias("indexed"), F.lit(False).alias("asks")),
        F.struct(F.col("other").alias("i"), F.col("own").alias("j"), F.lit(False).alias("indexed"), F.lit(True).alias("asks")),
    )
    # A group of its own per file; numbers below zero keep it from the shared ones.
    large_group = -1 - F.abs(F.shiftrightunsigned(F.xxhash64(*file), 2))
    gridded = grid.select(large_group.alias("group"), F.inline(cells), "word", "n", *file).where(
        F.col("indexed") | (F.col("shorter") == F.char_length("word"))
    )
    return small.unionByName(gridded)


class Index:
    """Bitsets over some words, one per (position, letter), and per file and length the words that lie there."""

    def __init__(self, words: Iterable[tuple[str, tuple]]):
        self.words: list[str] = []
        self.at: dict[tuple[int, str], int] = {}
        self.held: dict[tuple, int] = {}
        for number, (word, file) in enumerate(words):
            bit = 1 << number
            self.words.append(word)
            for slot in enumerate(word):
                self.at[slot] = self.at.get(slot, 0) | bit
            of_length = (*file, len(word))
            self.held[of_length] = self.held.get(of_length, 0) | bit

    def near(self, word: str, file: tuple) -> int:
        """Words of a file one letter from ``word``, its shorter or equal ones; found by this half alone."""
        same, longer = (self.held.get((*file, length), 0) for length in (len(word), len(word) + 1))
        exact, replaced, more = same | longer, 0, 0
        half, side = len(word) // 2, file[1]
        known = 0
        for place, letter in enumerate(word):
            here, next_on = self.at.get((place, letter), 0), self.at.get((place + 1, letter), 0)
            replaced = (replaced & here) | (exact & ~here)
            more = (more | exact) & next_on
            exact &= here
            if place == half - 1 and side == "end":
                known = exact  # the words that start alike are found under the start
            if not (exact | replaced | more):
                return 0
        return ((replaced & same) | ((more | exact) & longer)) & ~known


def bits(found: int) -> Iterator[int]:
    """Numbers of the bits that are set."""
    while found:
        lowest = found & -found
        yield lowest.bit_length() - 1
        found ^= lowest


def _near_words(rows: pd.DataFrame) -> pd.DataFrame:
    """Per word of a group: how many words of it are near, and the most frequent of them."""
    files = list(zip(rows["shorter"].tolist(), rows["side"].tolist(), rows["part"].tolist()))
    words, counts = rows["word"].tolist(), rows["n"].tolist()
    indexed = [k for k, flag in enumerate(rows["indexed"].tolist()) if flag]
    index = Index((words[k], files[k]) for k in indexed)
    near: dict[str, list] = {}

    def meets(word: str, other: str, n: int) -> None:
        met = near.setdefault(word, [0, 0, ""])
        met[0] += 1
        if n > met[1] or (n == met[1] and other < met[2]):
            met[1:] = n, other

    for k, asks in enumerate(rows["asks"].tolist()):
        if asks:
            word = words[k]
            for found in bits(index.near(word, files[k])):
                other = index.words[found]
                meets(word, other, counts[indexed[found]])
                if len(other) > len(word):  # equal lengths ask each other
                    meets(other, word, counts[k])
    columns = ["word", "near", "best_n", "best"]
    return pd.DataFrame([(word, *met) for word, met in near.items()], columns=columns)


def near_words(words: DataFrame, letters: int = GROUP_LETTERS) -> DataFrame:
    """Of a stored table of distinct words (word, n): word, n_near, best_n and best, where there is a near word."""
    partial = (
        _grouped(_filed(words), letters)
        .groupBy("group", "i", "j").applyInPandas(_near_words, _PARTIAL)
    )
    # Of equally frequent ones the smaller: strings order by code point.
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    return partial.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.word").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """Of a stored table (word, form): word, root. Each step doubles how far a word has followed its forms.

    Forms are more frequent than their words, so there are no cycles, and steps grow with log log n.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = reached.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = stored(
            reached.join(onward, F.col("root") == F.col("_at"), "left")
            .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "spelling-roots",
        )
        reached = moved.select("word", "root")
        if moved.where("_moved").limit(1).count() == 0:
            return reached


def variants(words: DataFrame, ratio: int = RATIO, letters: int = GROUP_LETTERS) -> DataFrame:
    """Of distinct words (word, n): word, form, root, n, n_near, form_n."""
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = near_words(words, letters)
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    followed = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(followed, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def report(docs: DataFrame) -> DataFrame:
    """Spelling variants of the words of documents: word, form, root, n, n_near, form_n."""
    return variants(vocabulary(docs))
