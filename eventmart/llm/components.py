"""Connected components of a table of links, by alternating large and small stars.

Each step replaces links by links to the smallest neighbour and is written to the shared folder; steps grow with the
logarithm of the longest chain. Nodes with very many links reach the shuffle as partial minima, and the joins back
to them can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a, b), a > b: one star step."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("least"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return moved.where("a != b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).head())


def components(links: DataFrame) -> DataFrame:
    """Per linked node: node, component (its smallest node). ``links`` has a and b; order and repeats don't matter."""
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    links = stored(ordered, "links")
    before = _state(links)
    while before[0]:
        links = stored(_star(_star(links, large=True), large=False), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    members = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
