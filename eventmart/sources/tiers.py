"""Stored tables, one root folder each, partitioned by ``date``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.functions import between_dates
from eventmart.functions.ranges import Day, as_date
from eventmart.sources.files import exists
from eventmart.sources.manifest import folder


def read_tier(
    spark: SparkSession,
    root: str,
    start: Day = None,
    end: Day = None,
    schema: StructType | None = None,
) -> DataFrame:
    """A stored table, limited to days; the limit prunes partitions.

    With a ``schema``, no file is opened for planning and a table nobody has written yet is empty.
    """
    if schema is not None and not exists(spark, root):
        return spark.createDataFrame([], schema).where(between_dates("date", start, end))
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(root).where(between_dates("date", start, end))


def read_dates(spark: SparkSession, root: str, dates: Iterable[Day], schema: StructType) -> DataFrame:
    """Some dates of a stored table (None: rows without one); only their folders are listed."""
    root = root.rstrip("/")
    there = [path for day in dates if exists(spark, path := f"{root}/{folder('date', as_date(day))}")]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*there)


def read_runs(spark: SparkSession, root: str, dates: Mapping[Day, Iterable[Day]], schema: StructType) -> DataFrame:
    """What some runs have stored: ``dates`` says, as the manifest does, which dates each has filled."""
    root = root.rstrip("/")
    there = [f"{root}/{folder('date', day)}/{folder('run_date', run)}" for run, days in dates.items() for day in days]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*there)


def read_quarantine(spark: SparkSession, root: str, runs: Iterable[Day]) -> DataFrame:
    """Raw lines with a fault of some runs: tracking, line, run_date, fault; only their folders are listed."""
    root = root.rstrip("/")
    there = [path for run in runs if exists(spark, path := f"{root}/{folder('run_date', as_date(run))}")]
    schema = "tracking STRING, activityParam STRING, run_date DATE, fault STRING"
    rows = spark.read.schema(schema).option("basePath", root).parquet(*there) if there else spark.createDataFrame([], schema)
    return rows.withColumnRenamed("activityParam", "line")


def calendar(spark: SparkSession, start: str, end: str, step: str = "1 day") -> DataFrame:
    """One row per step from ``start`` to ``end``; dates for steps of days, else timestamps."""
    if step.split()[-1].startswith("day"):
        first, last = F.lit(as_date(start)), F.lit(as_date(end))
    else:
        first, last = (F.lit(text).cast("timestamp_ntz") for text in (start, end))
    steps = F.sequence(first, last, F.expr(f"INTERVAL {step}"))
    return spark.range(1).select(F.explode(steps).alias("moment"))


def missing_days(
    spark: SparkSession, have: DataFrame, start: str, end: str, day_column: str = "date"
) -> DataFrame:
    """Days of a range on which ``have`` holds no rows.

    Asked of a stored table, only the partition column is read. A day counts as done by its rows, not
    by its folder, so a run that failed half-way is listed again.
    """
    done = have.where(between_dates(day_column, start, end)).select(
        F.col(day_column).alias("moment")
    )
    return (
        calendar(spark, start, end)
        .join(done.distinct(), "moment", "left_anti")
        .select(F.col("moment").alias("date"))
    )
