"""Benchmark decontamination with a positional inverted index, in DataFrame operations alone.

The index holds one posting (term, key, pos) per word of the training texts. Each task sorts the postings of its own
texts by term and writes them, so that building shuffles nothing and every file is an index of its part, in which
a term's postings lie together. A further posting marks each text's end and so holds its number of words. A phrase is looked up from its two rarest terms: their postings, moved back
by the term's place in the phrase, must agree in text and start. Terms are hashes in the index; what agrees is then
compared word by word with the text itself, so that a hash can neither add an occurrence nor lose one.

Texts are not shuffled to be compared: the keys of those with candidates are broadcast, up to a checked number, beyond
which that join shuffles. Other broadcasts are Spark's own choice by stored size. A term, phrase or text with a large share of the postings is spread by (phrase, text, start).

Null and wordless texts have no words, no windows and no hits. Texts are known by a hash of doc_id and text: repeated
rows get equal results, one each. Null item ids are written ``null``; items of a repeated id count as one. Empty
tables: documents without items are clean; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import fresh, small_enough, stored, words

WINDOW = 13
_END = ""  # stands for the end of a text; no word is empty
_BROADCAST_KEYS = 4_000_000  # 8 bytes each


def text_key() -> Column:
    """What a training text is known by in the index."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def build_index(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Postings of all words: term, key, pos. Written to ``path``, else to the shared folder."""
    tokens = F.concat(words(F.col("text")), F.array(F.lit(_END)))
    postings = (
        documents.select(text_key().alias("key"), tokens.alias("w"))  # before the explode, so that it carries no text
        .select("key", F.posexplode("w").alias("pos", "word"))
        .select(F.xxhash64("word").alias("term"), "key", "pos")
        .sortWithinPartitions("term")
    )
    if path is None:
        return stored(postings, "postings")
    postings.write.parquet(path)
    return documents.sparkSession.read.schema(postings.schema).parquet(path)


def sizes(index: DataFrame) -> DataFrame:
    """Number of words of each text: key, n_words."""
    ends = index.where(F.col("term") == F.xxhash64(F.lit(_END)))
    return ends.groupBy("key").agg(F.max("pos").cast("long").alias("n_words"))


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows of the items' words: window, phrase, n, items that hold it."""
    tokens = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words(F.col("text")).alias("w")
    ).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = tokens.select("item", "w", F.explode(starts).alias("at"))
    phrase = F.concat_ws(" ", F.slice("w", F.col("at"), F.lit(size)))
    return (
        cut.select("item", phrase.alias("phrase"))
        .groupBy("phrase").agg(F.collect_set("item").alias("items"))
        .select(F.xxhash64("phrase").alias("window"), "phrase", F.size(F.split("phrase", " ")).alias("n"), "items")
    )


def _terms(phrases: DataFrame) -> DataFrame:
    """Each window's terms with their places."""
    return phrases.select(
        "window", "n", F.posexplode(F.split("phrase", " ")).alias("place", "word")
    ).select("window", "n", "place", F.xxhash64("word").alias("term"))


def _frequencies(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings per term that occurs."""
    asked = stored(terms.select("term").distinct(), "terms")
    return index.select("term").join(asked, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def anchors(index: DataFrame, phrases: DataFrame, most: int = 2) -> DataFrame:
    """The rarest terms of each window whose terms all occur: window, n, place, term, rarity from 1."""
    terms = _terms(phrases)
    known = terms.join(_frequencies(index, terms), "term", "left")
    rare = Window.partitionBy("window").orderBy("df", "place")
    return (
        known.withColumn("missing", F.max(F.col("df").isNull()).over(Window.partitionBy("window")))
        .withColumn("rarity", F.row_number().over(rare))
        .where((F.col("rarity") <= most) & ~F.col("missing"))
        .select("window", "n", "place", "term", "rarity")
    )


def candidates(index: DataFrame, rarest: DataFrame) -> DataFrame:
    """Where the offset-adjusted postings of all of a window's anchors agree: key, window, start, n."""
    wanted = F.when(F.col("n") == 1, 1).otherwise(3)  # one bit per anchor
    return (
        index.join(stored(rarest, "anchors"), "term")
        .select("key", "window", "n", (F.col("pos") - F.col("place")).alias("start"), "rarity")
        .where("start >= 0")
        .groupBy("key", "window", "start", "n")
        .agg(F.bit_or(F.when(F.col("rarity") == 1, 1).otherwise(2)).alias("seen"))
        .where(F.col("seen") == wanted)
        .select("key", "window", "start", "n")
    )


def occurrences(documents: DataFrame, index: DataFrame, phrases: DataFrame) -> DataFrame:
    """Exact matches: key, start, n, items; one row per text, window and place."""
    found = stored(candidates(index, anchors(index, phrases)), "candidates")
    keys = stored(found.select("key").distinct(), "candidate-keys")
    texts = documents.select(text_key().alias("key"), "text").join(
        small_enough(keys, _BROADCAST_KEYS), "key", "left_semi"
    )
    per_text = found.groupBy("key").agg(F.collect_list(F.struct("window", "start", "n")).alias("found"))
    read = (
        texts.dropDuplicates(["key", "text"]).join(per_text, "key")
        .select("key", words(F.col("text")).alias("w"), "found")
        .select("key", "w", F.explode("found").alias("f"))
        .select("key", "f.*", F.concat_ws(" ", F.slice("w", F.col("f.start") + 1, F.col("f.n"))).alias("phrase"))
    )
    return read.join(phrases.drop("n"), ["window", "phrase"]).select("key", "start", "n", "items")


def contamination(documents: DataFrame, items: DataFrame, size: int = WINDOW, index: DataFrame | None = None) -> DataFrame:
    """Per text: key, n_words, n_hit (words within any occurrence) and the sorted ids of the items that occur."""
    phrases = stored(windows(items, size), "windows")
    index = build_index(documents) if index is None else index
    covered = F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)))
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))))
    hits = (
        occurrences(documents, index, phrases)
        .groupBy("key")
        .agg(F.size(F.array_distinct(covered)).cast("long").alias("n_hit"), ids.alias("items"))
    )
    return sizes(index).join(hits, "key", "left").select(
        "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def is_contaminated(n_hit: Column, total: Column) -> Column:
    """At least a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= total)


def report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = documents.select("doc_id", text_key().alias("key"))
    return rows.join(contamination(documents, items), "key").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they are."""
    bad = contamination(documents, items).where(is_contaminated(F.col("n_hit"), F.col("n_words")))
    key = fresh(documents, "key")[0]
    bad = stored(bad.select(F.col("key").alias(key)), "contaminated")
    return documents.join(small_enough(bad, _BROADCAST_KEYS), text_key() == F.col(key), "left_anti")


def near(index: DataFrame, phrases: DataFrame, span: int) -> DataFrame:
    """Proximity matches: key and window where all distinct words of the window lie within ``span`` words, in any order.

    The postings of a window's rarest term are centres; those of its other terms count if they are near one.
    """
    terms = _terms(phrases)
    centre = stored(anchors(index, phrases, 1).select("window", F.col("term").alias("rarest")), "centres")
    asked = stored(terms.select("window", "term").distinct(), "near-terms")
    needed = asked.groupBy("window").agg(F.count(F.lit(1)).alias("needed"))
    centres = index.join(centre.withColumnRenamed("rarest", "term"), "term").select(
        "window", "key", F.col("pos").alias("at")
    )
    others = index.join(asked.join(centre.select("window"), "window"), "term").select("window", "key", "term", "pos")
    around = (
        centres.join(others, ["window", "key"])
        .where(F.abs(F.col("pos") - F.col("at")) < span)
        .groupBy("window", "key", "at").agg(F.collect_list(F.struct("pos", "term")).alias("seen"))
        .join(needed, "window")
    )
    # Some place in the list from which all words come within the span.
    complete = F.exists("seen", lambda first: F.size(F.array_distinct(F.transform(
        F.filter("seen", lambda x: (x["pos"] >= first["pos"]) & (x["pos"] < first["pos"] + span)),
        lambda x: x["term"],
    ))) == F.col("needed"))
    return around.where(complete).select("key", "window").distinct()
