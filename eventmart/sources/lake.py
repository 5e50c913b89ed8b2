"""Writers.

Days are of very different size and one day is often nearly all of a run, so rows are not brought
together by hashing the date alone: the rebalance hint lets adaptive execution split a large day into
several tasks, and files, and merge small ones.
"""

from __future__ import annotations

import functools
import logging
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

from eventmart.functions import instant, to_int
from eventmart.functions.ranges import Day, as_date
from eventmart.operators.standardize import with_partition_columns
from eventmart.schemas import TIER1, TIER1_STORED
from eventmart.sources.files import add, delete, listed_files, matching, move
from eventmart.sources.manifest import Manifest, folder, value_of

_EVENT = "event"  # the target of rows that go to the event table
_LOG = logging.getLogger(__name__)
_RUN_FOLDER = r"/(\d{4}-\d{2}-\d{2})/(?:date=|\d{2}/)"


def _stage(
    table: DataFrame, partitions: Sequence[str], sort: Sequence[str], root: str, compression: str
) -> tuple[str, list[str]]:
    """Write into a folder of its own beside ``root``; returns it and the partitions it has, as paths below it.

    These are then put in the place of those in ``root``. So only what this write holds is listed, however large the table is.
    """
    staged = f"{root.rstrip('/')}-staging/{uuid.uuid4().hex}"
    (
        table.hint("rebalance", *(F.col(c) for c in partitions))
        .sortWithinPartitions(*partitions, *sort)
        .write.partitionBy(*partitions)
        .option("compression", compression)
        .parquet(staged)
    )
    found = matching(table.sparkSession, "/".join([staged, *(f"{name}=*" for name in partitions)]))
    return staged, ["/".join(path.rstrip("/").split("/")[-len(partitions):]) for path in found]


def _targets(events: DataFrame, quarantine: str | None) -> DataFrame:
    """Rows for the event table, and for the lines with a fault rows for the quarantine that carry the line's text."""
    if quarantine is None:
        return events.where(F.col("trackingId").isNotNull()).withColumn("target", F.lit(_EVENT))
    stays = F.when(F.col("trackingId").isNotNull(), F.lit(_EVENT))
    return events.withColumn("target", F.explode(F.array_compact(F.array(stays, F.col("fault"))))).withColumns({
        "date": F.when(F.col("target") == _EVENT, F.col("date")),
        "activityParam": F.when(F.col("target") == _EVENT, F.col("activityParam")).otherwise(F.col("line")),
    })


def write_tier1(
    events: DataFrame,
    root: str,
    run_date: Day = None,
    runs: Sequence[Day] = (),
    compression: str = "zstd",
    quarantine: str | None = None,
) -> None:
    """Store standard events below ``root/date=<event date>/run_date=<run>``.

    A run also carries late events of earlier dates. Writing a run again replaces exactly its own rows
    and leaves those of other runs. ``run_date`` is a column of ``events`` if not given; ``runs`` then
    names all runs that ``events`` stands for, also those without rows. Partitions an earlier attempt
    of these runs filled and this one does not are removed afterwards.

    Rows without an application are dropped, unless there is a ``quarantine``: in the same pass, lines with a ``fault`` (see
    ``with_faults``) are then stored there, below ``run_date=<run>/fault=<fault>``, with their text as ``activityParam``
    and what could be read of them in the other columns.

    The manifest beside the table says which partitions each run has filled, in which version. The named runs' partitions
    get the new version before anything changes, so that what was made from them is known to be stale even
    if this write is cut short.
    """
    spark, root = events.sparkSession, root.rstrip("/")
    if run_date is not None:
        events = events.withColumn("run_date", F.lit(as_date(run_date)))
    named = {as_date(run) for run in (run_date, *runs) if run is not None}
    version = uuid.uuid4().hex
    manifest = Manifest(spark, root)
    before = manifest.of_runs(named)
    manifest.replace({run: before[run] for run in named if before[run]}, version)

    rows = _targets(with_partition_columns(events), quarantine).select("target", *TIER1_STORED.names)
    staged, partitions = _stage(rows, ["target", "date", "run_date"], ["trackingId", "eventTimeStamp"], root, compression)
    if quarantine is not None:
        for run in named:
            delete(spark, f"{quarantine}/{folder('run_date', run)}")
    after: dict[Day, set[Day]] = {run: set() for run in named}
    for partition in partitions:
        target, day, run = partition.split("/")
        if target == f"target={_EVENT}":
            move(spark, f"{staged}/{partition}", f"{root}/{day}/{run}")
            after.setdefault(value_of(run), set()).add(value_of(day))
        else:
            move(spark, f"{staged}/{partition}", f"{quarantine}/{run}/{target.replace('target', 'fault')}")
    delete(spark, staged)
    before |= manifest.of_runs(set(after) - named)
    for run, days in before.items():
        for day in days - after[run]:
            delete(spark, f"{root}/{folder('date', day)}/{folder('run_date', run)}")
    manifest.replace(after, version)


def add_tier1(events: DataFrame, root: str, quarantine: str, compression: str = "zstd") -> DataFrame:
    """Store further events beside those that their runs have stored; as ``write_tier1`` does, but nothing is replaced.

    Doing it twice stores the rows twice: whoever calls it must know a run that was cut short, and write that as a whole. The
    grown partitions get a new version before they change; those are returned as rows of the manifest.
    """
    spark, root = events.sparkSession, root.rstrip("/")
    rows = _targets(with_partition_columns(events), quarantine).select("target", *TIER1_STORED.names)
    staged, partitions = _stage(rows, ["target", "date", "run_date"], ["trackingId", "eventTimeStamp"], root, compression)
    cut = [partition.split("/") for partition in partitions]
    version = uuid.uuid4().hex
    grown = spark.createDataFrame(
        [(value_of(day), version, value_of(run)) for target, day, run in cut if target == f"target={_EVENT}"],
        "date DATE, version STRING, run_date DATE",
    )
    Manifest(spark, root).renew(grown)
    for target, day, run in cut:
        into = f"{root}/{day}/{run}" if target == f"target={_EVENT}" else f"{quarantine}/{run}/{target.replace('target', 'fault')}"
        add(spark, f"{staged}/{target}/{day}/{run}", into)
    delete(spark, staged)
    return grown


def write_tier2(
    mart: DataFrame, root: str, days: Sequence[Day] = (), compression: str = "zstd"
) -> None:
    """Store a mart below ``root/date=<event date>``, replacing the dates it holds.

    ``days`` are the dates it was computed for (None: rows without a date); those on which it has no
    rows are removed from the store. Rows are sorted within files, which keeps repeated applications and users together and lets
    a scan skip row groups. Missing sort columns (the daily mart has no hour) are left out.
    """
    order = ["app_name", "os_typecode", "event_hour", "c_id"]
    dated = mart.withColumn("date", F.col("event_date"))
    spark, root = mart.sparkSession, root.rstrip("/")
    staged, filled = _stage(dated, ["date"], [c for c in order if c in mart.columns], root, compression)
    for partition in filled:
        move(spark, f"{staged}/{partition}", f"{root}/{partition}")
    delete(spark, staged)
    for partition in {folder("date", as_date(day)) for day in days} - set(filled):
        delete(spark, f"{root}/{partition}")


def write_sorted(
    table: DataFrame,
    path: str,
    sort_col: str,
    files: int,
    compression: str = "gzip",
    dictionary: bool = True,
    row_group_bytes: int = 128 * 1024 * 1024,
    page_bytes: int = 2 * 1024 * 1024,
    dictionary_page_bytes: int = 8 * 1024 * 1024,
) -> None:
    """Write ``files`` parquet files in the order of ``sort_col`` across and within files.

    Ranges are cut by the sort column and, within one of its values, by the task that read the row: a
    value that fills many rows is spread over several files, all adjacent in the order.
    """
    (
        table.withColumn("_reader", F.spark_partition_id())
        .repartitionByRange(files, sort_col, "_reader")
        .sortWithinPartitions(sort_col)
        .drop("_reader")
        .write.mode("overwrite")
        .option("compression", compression)
        .option("parquet.enable.dictionary", str(dictionary).lower())
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.dictionary.page.size", dictionary_page_bytes)
        .parquet(path)
    )


def _by_schema(spark: SparkSession, paths: list[str]) -> list[tuple[StructType, list[str]]]:
    """Paths grouped so that the files of a group can be read with one schema.

    Spark reads the footers, in tasks; if they contradict each other, either half is tried alone, a folder at last by
    its files. Formats change from some run on, so with paths in order of runs this takes few steps.
    """
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
    try:
        return [(reader.parquet(*paths).schema, paths)]
    except (Py4JJavaError, PySparkException) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    if len(paths) == 1:
        paths = [row["path"] for row in listed_files(spark, paths).select("path").orderBy("path").collect()]
    half = len(paths) // 2
    groups: list[tuple[StructType, list[str]]] = []
    for schema, part in _by_schema(spark, paths[:half]) + _by_schema(spark, paths[half:]):
        alike = next((known for known in groups if known[0] == schema), None)
        if alike:
            alike[1].extend(part)
        else:
            groups.append((schema, list(part)))
    return groups


def relayout(
    spark: SparkSession, src: str, dst: str, tz: str = "UTC", compression: str = "zstd"
) -> None:
    """Gather ``src/<run date>/date=<event date>/`` or ``src/<run date>/<hour>/`` folders into one root by event date.

    The run date comes from the path, and files that were small in ``src`` are compacted on the way. Files
    of different column types are read by a scan for each of their schemas: times that are text are local to ``tz``, numbers that are text give
    their whole part, columns that a file lacks are NULL. Files that lie in no run folder keep a NULL run date; a
    warning says how many there are.
    """
    folders = sorted(matching(spark, f"{src.rstrip('/')}/*"))
    run = F.regexp_extract(F.col("_metadata.file_path"), _RUN_FOLDER, 1)

    def typed(column: StructField, held: dict[str, str]) -> Column:
        if column.name not in held:
            return F.lit(None).cast(column.dataType)
        if isinstance(column.dataType, TimestampType) and held[column.name] == "string":
            return instant(F.col(column.name).try_cast("timestamp_ntz"), tz)
        if isinstance(column.dataType, IntegerType) and held[column.name] == "string":
            return to_int(F.col(column.name))
        return F.col(column.name).try_cast(column.dataType)

    stray = listed_files(spark, folders).where(F.regexp_extract("path", _RUN_FOLDER, 1) == "")
    found = stray.agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("first")).head()
    if found["files"]:
        _LOG.warning("%d files lie in no run folder, such as %s", found["files"], found["first"])
    scans = []
    for schema, paths in _by_schema(spark, folders):
        old = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)
        held = dict(old.dtypes)
        scans.append(old.select(*(typed(c, held).alias(c.name) for c in TIER1), run.try_cast("date").alias("run_date")))
    write_tier1(functools.reduce(DataFrame.unionByName, scans), dst, compression=compression)
