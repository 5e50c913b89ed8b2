"""Raw vendor logs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.ranges import Day, as_date
from eventmart.schemas import RAW_DAY_IN_PATH, RAW_FOLDER, raw_schema
from eventmart.sources.files import matching


def delivered_days(spark: SparkSession, vendor: str, root: str, days: Sequence[Day]) -> list[Day]:
    """Those of some days for which the vendor has a folder."""
    anywhere = f"{root.rstrip('/')}/{RAW_FOLDER.split('/', 1)[0].format(vendor=vendor.lower())}/*/*"
    there = {"/".join(folder.rstrip("/").split("/")[-3:]) for folder in matching(spark, anywhere)}
    return [day for day in days if RAW_FOLDER.format(vendor=vendor.lower(), day=as_date(day)) in there]


def delivered_folders(spark: SparkSession, vendor: str, root: str, days: Sequence[Day]) -> list[str]:
    """The vendor's folders of some days, where there are any."""
    present = delivered_days(spark, vendor, root, days)
    return [f"{root.rstrip('/')}/{RAW_FOLDER.format(vendor=vendor.lower(), day=as_date(day))}" for day in present]


def read_raw(
    spark: SparkSession, vendor: str, root: str, days: Sequence[Day]
) -> DataFrame | None:
    """JSON logs of some days in a single scan; None if the vendor has no folder for any of them.

    Files may lie in the day's folder or in hour folders below it. The schema is given, so there is no
    inference pass and a field of an unexpected type is NULL instead of changing the column; such
    lines are kept in ``_corrupt_record``. ``run_date`` is the day of the folder.
    """
    present = delivered_folders(spark, vendor, root, days)
    return read_raw_paths(spark, vendor, present) if present else None


def read_raw_paths(spark: SparkSession, vendor: str, paths: Sequence[str]) -> DataFrame:
    """The same of some of a vendor's folders or files, whatever characters their names have."""
    path = F.col("_metadata.file_path")
    month = F.regexp_extract(path, RAW_DAY_IN_PATH, 1)
    day_of_month = F.regexp_extract(path, RAW_DAY_IN_PATH, 2)
    return (
        spark.read.schema(raw_schema(vendor))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("recursiveFileLookup", "true")
        .json([re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for path in paths])
        .withColumn("run_date", F.concat_ws("-", month, day_of_month).try_cast("date"))
    )
