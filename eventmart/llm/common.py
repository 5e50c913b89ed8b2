"""What several of these operators need: reading the test tables, stored steps, numbers without gaps."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.sources.files import shared_folder

#: What lies between words: ASCII other than letters and digits. Words are the rest, A-Z in lower case.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables. Python workers then find this package where the driver did, as an installed one would be."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}{os.pathsep}{known}".rstrip(os.pathsep)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, and outlives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Let the session send Python workers at most so many rows at once, fewer if it does so already.

    Spark's 10,000 rows of whole texts, or of their words' hashes, are a task's whole part of the input, and workers keep
    memory they have once had. The setting is read when a query runs, so it stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes not to be a column's."""
    taken = {c.lower() for c in df.columns}
    return ["_" * next(i for i in range(len(taken) + 1) if "_" * i + n not in taken) + n for n in names]


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; null stays null."""
    slow = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    found = F.array_remove(F.split(lower_ascii(text), _BETWEEN), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def buckets(spark: SparkSession) -> int:
    """Parts a group is cut into; follows the number of shuffle partitions chosen for the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a stored table of narrow rows, to be broadcast if it has at most so many; else joins shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def join_by_frequency(rows: DataFrame, found: DataFrame, on: str | list[str], uses: str, share: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with a table of distinct keys that says under ``uses`` how many rows have each.

    Keys of more than one in ``share`` rows are fewer than ``share``: they are broadcast, whatever the size of the tables. No
    other key is hot, so the rest is shuffled or, if Spark finds it small, broadcast. ``rows`` and ``found`` are read twice.
    """
    on = [on] if isinstance(on, str) else on
    total = found.agg(F.sum(uses)).head()[0] or 0
    hot = F.col(uses) * share > total
    often = rows.join(F.broadcast(found.where(hot).drop(uses)), on)
    others = rows.join(F.broadcast(found.where(hot).select(*on)), on, "left_anti")
    seldom = others.join(found.where(~hot).drop(uses), on)
    return often.unionByName(seldom)


def gapless(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, however large the group.

    A group is cut into parts by the hash of ``order``; rows are numbered within a part, and parts start
    where the parts before end. ``by`` must not hold nulls. ``df`` is read twice, so it should be stored.
    """
    cut = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(buckets(df.sparkSession))))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order))
    return (
        cut.withColumn("_row", within)
        .join(starts, [*by, "_part"])
        .withColumn(name, (F.col("_start") + F.col("_row") - 1).cast("long"))
        .drop("_part", "_row", "_start")
    )
