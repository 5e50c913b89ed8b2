"""Line deduplication by frequency within a site.

A line is boilerplate of a site if it is on more than ``ratio`` of the site's pages, and on ``min_pages`` at least. A page
counts once however often it holds the line. Pages that hold a line are counted by the line's hash, with partial sums
before the shuffle, so that a site or line with a third of all rows is one row per task; only lines whose hash passes
are counted once more as text, so that equal hashes of unlike lines drop nothing. A site has at most (lines
of a page / ratio) such lines: the list joined to its pages is bounded by what its pages hold on average, and Spark
broadcasts the lists by their stored size, else shuffles and splits a large site.

With ``distinct_texts`` the pages of a site are its distinct texts (told apart by 64-bit hash, null being one of them)
instead of its rows: copies of one document are one page, so their number makes no line of theirs boilerplate. Copies that
differ in a few words are pages each, and a line that ``ratio`` of a site's pages share through them still goes, from all of them.

Blank lines are kept and not counted. Null texts stay null; null sites are one site; repeated rows are pages each, unless
``distinct_texts``. A text of boilerplate alone becomes empty. Empty tables give empty results; further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import fresh, stored

RATIO = 0.05
MIN_PAGES = 3
_SEPARATOR = "\n"


def host(url: Column) -> Column:
    """The site of a page's address, in lower case; null if there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def _lines(text: Column) -> Column:
    return F.split(text, _SEPARATOR)


def _frequent(counted: DataFrame, pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    return counted.join(pages, "_site").where(
        (F.col("_on") >= min_pages) & (F.col("_on") > F.lit(ratio) * F.col("_pages"))
    )


def _pages(rows: DataFrame, by: list[str], name: str, distinct_texts: bool) -> DataFrame:
    """Pages of each group, from a row per page; both steps sum up before they shuffle."""
    if distinct_texts:
        rows = rows.select(*by, "_copy").distinct()
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def boilerplate(
    docs: DataFrame, site: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES, distinct_texts: bool = False
) -> DataFrame:
    """Per site (as a string, null as such marked): the lines to drop."""
    sited = docs.select(_site(site).alias("_site"), F.col("text").alias("_text"))
    if distinct_texts:
        sited = sited.withColumn("_copy", F.xxhash64("_text"))
    kept = [c for c in sited.columns if c != "_text"]
    pages = stored(_pages(sited, ["_site"], "_pages", distinct_texts), "site-pages")
    lines = sited.select(*kept, F.explode(F.array_distinct(_lines(F.col("_text")))).alias("_line")).where(
        F.trim("_line") != ""
    )
    hashed = lines.select(*kept, F.xxhash64("_line").alias("_hash"))
    likely = _frequent(_pages(hashed, ["_site", "_hash"], "_on", distinct_texts), pages, ratio, min_pages)
    likely = stored(likely.select("_site", "_hash"), "likely-lines")
    found = lines.withColumn("_hash", F.xxhash64("_line")).join(likely, ["_site", "_hash"], "left_semi")
    exact = _pages(found, ["_site", "_line"], "_on", distinct_texts)
    return (
        _frequent(exact, pages, ratio, min_pages)
        .groupBy("_site").agg(F.array_sort(F.collect_list("_line")).alias("_drop"))
    )


def _site(site: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), site.cast("string")), F.lit("null"))


def drop_boilerplate(
    docs: DataFrame, site: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES,
    counts: tuple[str, str] | None = ("n_lines", "n_dropped"), distinct_texts: bool = False,
) -> DataFrame:
    """``docs`` with cleaned ``text``, and under the names of ``counts`` the lines of each and those dropped."""
    own, drop, kept = fresh(docs, "site", "drop", "kept")
    marked = stored(boilerplate(docs, site, ratio, min_pages, distinct_texts), "boilerplate")
    marked = marked.select(F.col("_site").alias(own), F.col("_drop").alias(drop))
    lines = _lines(F.col("text"))
    stays = F.filter(lines, lambda line: ~F.array_contains(F.col(drop), line))
    cleaned = docs.withColumn(own, _site(site)).join(marked, own, "left").withColumn(
        kept, F.when(F.col(drop).isNull(), lines).otherwise(stays)
    )
    if counts:
        n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
        n_kept = F.when(F.col("text").isNull(), 0).otherwise(F.size(kept))
        cleaned = cleaned.withColumns({counts[0]: n_lines, counts[1]: n_lines - n_kept})
    return cleaned.withColumn("text", F.array_join(kept, _SEPARATOR)).drop(own, drop, kept)
