"""Hourly deliveries as a stream of new raw files.

Vendors add hour folders to a day, and late ones to days before. The stream only notices which run
days got new files, one small row per file; each of these days is then processed again as a whole by
the batch jobs, which replace exactly its rows. A micro-batch repeated after a failure therefore
changes nothing, and no event is kept in streaming state.

Each trigger lists the raw root; a file's age plays no role. Files that lie under no run day are logged
with their number. The stream does not notice a file that was replaced under its old name or has vanished; `catch_up` does, by
the ledger, which the days done here are entered in as well.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmart.plans.jobs import Lake, process_runs
from eventmart.schemas import RAW_DAY_IN_PATH

_LOG = logging.getLogger(__name__)
_ANY_AGE = "36500d"  # Spark's default ignores files a week older than the newest one

# Columns of Spark's binary file source; the content is not selected and so never read.
_FILE = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def follow_raw_logs(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    tz: str = "UTC",
    files_per_batch: int = 10_000,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the three tables up to date with the raw folders.

    Without an ``interval`` everything that has arrived is processed and the query ends, which suits an
    hourly schedule; with one (such as ``1 hour``) it keeps running.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", _ANY_AGE)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(lake.raw)
        .select(
            "path",
            F.concat_ws(
                "-",
                F.regexp_extract("path", RAW_DAY_IN_PATH, 1),
                F.regexp_extract("path", RAW_DAY_IN_PATH, 2),
            ).try_cast("date").alias("run_date"),
        )
    )

    def process(batch: DataFrame, _: int) -> None:
        days = batch.groupBy("run_date").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("first")).collect()
        for row in days:
            if row["run_date"] is None:
                _LOG.warning("%d files lie under no run day, such as %s", row["files"], row["first"])
        runs = sorted(row["run_date"] for row in days if row["run_date"])
        if runs:
            process_runs(batch.sparkSession, lake, runs, tz)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        arrivals.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(process)
        .start()
    )
