"""The delivery ledger: which raw files the event table was made from.

A run day is up to date if the files that lie in its folders are those of the ledger, by path, length and time of modification.
So a later hour, a file that was replaced under its name and one that has vanished are all noticed. A day whose folders
are gone altogether is left alone: raw logs may be cleared once they are stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.ranges import Day, as_date
from eventmart.schemas import RAW_DAY_IN_PATH, VENDORS
from eventmart.sources.files import delete, exists, listed_files, shared_folder
from eventmart.sources.manifest import folder
from eventmart.sources.raw import delivered_folders

_FILE = "vendor STRING, path STRING, length LONG, modified TIMESTAMP, run_date DATE"


def raw_files(spark: SparkSession, root: str, days: Sequence[Day]) -> DataFrame:
    """The raw files of some run days, of all vendors, as they are at this moment.

    One row per file; only the folders of these days are listed. The rows are stored, so they don't change with the files.
    """
    folders = [path for vendor in VENDORS for path in delivered_folders(spark, vendor, root, days)]
    if not folders:
        return spark.createDataFrame([], _FILE)
    path = F.col("path")
    listed = (
        listed_files(spark, folders).select(
            F.upper(F.regexp_extract(path, r"/thirdparty-([^/]+)/", 1)).alias("vendor"),
            "path",
            "length",
            F.col("modificationTime").alias("modified"),
            F.concat_ws(
                "-", F.regexp_extract(path, RAW_DAY_IN_PATH, 1), F.regexp_extract(path, RAW_DAY_IN_PATH, 2)
            ).try_cast("date").alias("run_date"),
        )
    )
    kept = shared_folder(spark, "raw-files")
    listed.write.parquet(kept)
    return spark.read.schema(_FILE).parquet(kept)


class Ledger:
    """The ledger of one warehouse, partitioned by run day."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path

    def of_runs(self, runs: Sequence[Day]) -> DataFrame:
        """Files that some runs were made from."""
        kept = [p for run in runs if exists(self._spark, p := f"{self.path}/{folder('run_date', as_date(run))}")]
        if not kept:
            return self._spark.createDataFrame([], _FILE)
        return self._spark.read.schema(_FILE).option("basePath", self.path).parquet(*kept)

    def record(self, files: DataFrame) -> None:
        """Say that the runs of these files are made from them, and from no others."""
        (
            files.repartition("run_date").sortWithinPartitions("run_date", "path")
            .write.partitionBy("run_date").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(self.path)
        )

    def forget(self, runs: Sequence[Day]) -> None:
        """Say that some runs are made from no files as yet: while they are written, and if that is cut short, they are due."""
        for run in runs:
            delete(self._spark, f"{self.path}/{folder('run_date', as_date(run))}")

    def more(self, files: DataFrame, runs: Sequence[Day]) -> DataFrame:
        """Files that have come to runs that still have all they were made from, unchanged; none of other runs."""
        known = self.of_runs(runs)
        changed = known.join(files, files.columns, "left_anti").select("run_date")
        new = files.join(known, files.columns, "left_anti")
        return new.join(known.select("run_date"), "run_date", "left_semi").join(changed, "run_date", "left_anti").select(files.columns)

    def due(self, files: DataFrame, runs: Sequence[Day]) -> DataFrame:
        """Run days, of those with files, whose files are not the ledger's: run_date."""
        known = self.of_runs(runs)
        differ = files.join(known, files.columns, "left_anti").unionByName(known.join(files, files.columns, "left_anti"))
        return differ.select("run_date").join(files.select("run_date"), "run_date", "left_semi").distinct()
