"""Which partitions of the event table each run has filled, and in which version of itself.

Small tables beside the stored ones, written by the writes and compared as DataFrames: nobody lists a table to find out what
has changed. A manifest is partitioned by run, so a write reads and replaces only the rows of its own runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.ranges import Day
from eventmart.sources.files import delete, exists, matching

_SCHEMA = "date DATE, version STRING, run_date DATE"
_NULL = "__HIVE_DEFAULT_PARTITION__"  # Spark's name for the partition of NULL


def folder(column: str, value: object) -> str:
    """How Spark names the partition of a value."""
    return f"{column}={_NULL if value is None else value}"


def value_of(partition: str) -> dt.date | None:
    """The date in a partition's name."""
    text = partition.split("=", 1)[1]
    return None if text == _NULL else dt.date.fromisoformat(text)


class Manifest:
    """The manifest of one event table, in a folder beside it."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        self.path = f"{self._root}-manifest"

    def of_runs(self, runs: Iterable[Day]) -> dict[Day, set[Day]]:
        """Event dates that some runs have filled; what comes to the driver is a list of days."""
        dates: dict[Day, set[Day]] = {run: set() for run in runs}
        self._take_stock()
        kept = [path for run in dates if exists(self._spark, path := f"{self.path}/{folder('run_date', run)}")]
        if kept:
            rows = self._spark.read.schema(_SCHEMA).option("basePath", self.path).parquet(*kept).collect()
            for row in rows:
                dates[row["run_date"]].add(row["date"])
        return dates

    def replace(self, dates: Mapping[Day, set[Day]], version: str) -> None:
        """Say of some runs which dates they fill now."""
        rows = [(day, version, run) for run, days in dates.items() for day in days]
        if rows:
            (
                self._spark.createDataFrame(rows, _SCHEMA).coalesce(1)
                .write.partitionBy("run_date").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(self.path)
            )
        for run, days in dates.items():
            if not days:
                delete(self._spark, f"{self.path}/{folder('run_date', run)}")

    def renew(self, grown: DataFrame) -> None:
        """Say that some partitions (date, version, run_date) have grown; the others of their runs stay as they are."""
        runs = [row["run_date"] for row in grown.select("run_date").distinct().collect()]
        self._take_stock()
        kept = [path for run in runs if exists(self._spark, path := f"{self.path}/{folder('run_date', run)}")]
        rows = grown
        if kept:
            held = self._spark.read.schema(_SCHEMA).option("basePath", self.path).parquet(*kept)
            rows = grown.unionByName(other_partitions(held, grown))
        rows = self._spark.createDataFrame(rows.collect(), _SCHEMA)  # a list of days; its files are replaced below
        (
            rows.coalesce(1)
            .write.partitionBy("run_date").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(self.path)
        )

    def rows(self) -> DataFrame:
        """The whole manifest: date, version, run_date."""
        self._take_stock()
        if not exists(self._spark, self.path):
            return self._spark.createDataFrame([], _SCHEMA)
        return self._spark.read.schema(_SCHEMA).parquet(self.path)

    def digests(self, rows: DataFrame | None = None) -> DataFrame:
        """One row per event date that has partitions: date and digest, a text that changes with any of them.

        Of the manifest as it is, or of ``rows`` like its own.
        """
        rows = self.rows() if rows is None else rows
        hashed = F.bit_xor(F.xxhash64(F.coalesce(F.col("run_date").cast("string"), F.lit("")), "version"))
        return rows.groupBy("date").agg(
            F.concat_ws(":", F.count(F.lit(1)).cast("string"), hashed.cast("string")).alias("digest")
        )

    def _take_stock(self) -> None:
        """Make the manifest of a table that was written before there were any; its folders are listed once."""
        if exists(self._spark, self.path) or not exists(self._spark, self._root):
            return
        held: dict[Day, set[Day]] = {}
        for path in matching(self._spark, f"{self._root}/date=*/run_date=*"):
            day, run = (value_of(part) for part in path.rstrip("/").split("/")[-2:])
            held.setdefault(run, set()).add(day)
        self.replace(held, "before")


def other_partitions(rows: DataFrame, grown: DataFrame) -> DataFrame:
    """Rows of a manifest that speak of other partitions than ``grown`` does."""
    same = rows["date"].eqNullSafe(grown["date"]) & rows["run_date"].eqNullSafe(grown["run_date"])
    return rows.join(grown, same, "left_anti")


class Stamps:
    """From which digest of the events each date of a mart was built, in a folder beside the mart; each build appends."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")
        self.path = f"{self._root}-stamps"

    def latest(self) -> DataFrame:
        """date and digest of the last build; of a mart from before there were stamps, an empty digest for each date it holds."""
        if exists(self._spark, self.path):
            rows = self._spark.read.schema("date DATE, digest STRING, built TIMESTAMP").parquet(self.path)
            last = F.max_by(F.struct("digest"), "built")
            return rows.groupBy("date").agg(last.alias("last")).select("date", "last.digest")
        held = [(value_of(path.rstrip("/").rsplit("/", 1)[-1]), "") for path in matching(self._spark, f"{self._root}/date=*")]
        return self._spark.createDataFrame(held, "date DATE, digest STRING")

    def add(self, built: DataFrame) -> None:
        """Append rows (date, digest); a null digest says that there were no events of the date."""
        rows = built.select("date", "digest", F.current_timestamp().alias("built"))
        rows.coalesce(1).write.mode("append").parquet(self.path)


def stale(digests: DataFrame, stamps: DataFrame) -> DataFrame:
    """Dates whose events are not those their mart was built from: date, and the events' digest now."""
    now, then = digests.alias("now"), stamps.alias("then")
    both = now.join(then, F.col("now.date").eqNullSafe(F.col("then.date")), "full_outer")
    return both.where(~F.col("now.digest").eqNullSafe(F.col("then.digest"))).select(
        # Rows of a side that is absent are all null; the undated day is null on the side that is there.
        F.when(F.col("now.digest").isNotNull(), F.col("now.date")).otherwise(F.col("then.date")).alias("date"),
        F.col("now.digest").alias("digest"),
    )
