"""The three batch jobs: raw logs to events, events to each of the two marts.

Each takes several days and does all of them in one Spark job. Running a job again for days it has
done before gives the same tables. What needs doing is found by comparing small tables: raw files with the ledger of those
the events were made from, and the events' manifest with the stamps of what the marts were built from.
"""

from __future__ import annotations

import datetime as dt
import functools
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions import between_dates
from eventmart.functions.ranges import Day, as_date
from eventmart.operators import FAULTS, event_by_user, purchase_by_user, standardize, with_faults
from eventmart.schemas import RAW_QUALITY, TIER1_STORED, VENDORS, stored
from eventmart.sources import (
    Ledger,
    Manifest,
    Stamps,
    add_tier1,
    delivered_days,
    other_partitions,
    raw_files,
    read_dates,
    read_quarantine,
    read_raw,
    read_raw_paths,
    read_runs,
    shared_folder,
    stale,
    write_tier1,
    write_tier2,
)
from eventmart.sources.claims import LEASE, Claims
from eventmart.sources.files import delete

_LOG = logging.getLogger(__name__)


class Lake:
    """Where the raw logs and, below one warehouse root, the tables lie (fixed folder names)."""

    def __init__(self, raw: str, warehouse: str):
        self.raw = raw.rstrip("/")
        root = warehouse.rstrip("/")
        self.events = f"{root}/tier1/event"
        self.event_by_user = f"{root}/tier2/eventByUser"
        self.purchase_by_user = f"{root}/tier2/purchaseByUser"
        self.quarantine = f"{root}/tier1/quarantine"
        self.raw_quality = f"{root}/tier1/rawQuality"
        self.ledger = f"{root}/ledger"
        self.due = f"{root}/due"


Mart = tuple[str, Callable[[DataFrame], DataFrame]]
_SUMS = ("event_count", "quantity_total", "amount_total")  # columns of the marts that add up


def standardize_days(
    spark: SparkSession, lake: Lake, days: Sequence[Day], tz: str = "UTC"
) -> None:
    """Raw logs of some run days, of whichever vendors have any, into the event table.

    A day without any raw folder is left as it is stored. Lines that name no application are not events; these, and those of
    which something could not be read, go to the quarantine in the same pass, and ``raw_quality`` counts all of them. The ledger gets the files as they were before they were read: one
    that changes meanwhile differs from it, and its day is done again.
    """
    files = raw_files(spark, lake.raw, days)
    events, runs = [], set()
    for vendor in VENDORS:
        delivered = delivered_days(spark, vendor, lake.raw, days)
        if delivered:
            raw = read_raw(spark, vendor, lake.raw, delivered)
            events.append(standardize(with_faults(raw, vendor), vendor, tz))
            runs.update(map(as_date, delivered))
    if events:
        everything = functools.reduce(DataFrame.unionByName, events)
        Ledger(spark, lake.ledger).forget(sorted(runs))
        write_tier1(everything, lake.events, runs=sorted(runs), quarantine=lake.quarantine)
        _count_lines(spark, lake, sorted(runs))
        Ledger(spark, lake.ledger).record(files)


def add_files(spark: SparkSession, lake: Lake, days: Sequence[Day], tz: str = "UTC") -> list[Day]:
    """Those of some run days that have only got more files: the new files' events into all three tables.

    No line that was read before is read again. The marts hold sums, so those of the new events are added to the dates
    that were built from the events as they were; other dates stay stale, for ``refresh_marts``. Sums are added up before the
    events are stored, from the mart that belongs to the events of then, and stamped with what the manifest then says and
    this change: if another job changes the same dates meanwhile, they are stale and built as a whole. The ledger forgets the
    days until all is stored, so a day of which the attempt is cut short is done as a whole. Returns the days that were done.
    """
    ledger, manifest = Ledger(spark, lake.ledger), Manifest(spark, lake.events)
    files = raw_files(spark, lake.raw, days)
    new = _kept(spark, ledger.more(files, days), "new-files")
    paths: dict[str, list[str]] = {}
    runs = set()
    for row in new.select("vendor", "path", "run_date").collect():
        paths.setdefault(row["vendor"], []).append(row["path"])
        runs.add(row["run_date"])
    if not runs:
        return []
    parsed = [
        standardize(with_faults(read_raw_paths(spark, vendor, found), vendor), vendor, tz) for vendor, found in paths.items()
    ]
    events = _kept(spark, functools.reduce(DataFrame.unionByName, parsed), "new-events")
    before = _kept(spark, manifest.rows(), "manifest")
    named = events.where(F.col("trackingId").isNotNull())
    sums = [_added(spark, mart, named, manifest.digests(before)) for mart in _marts(lake)]

    ledger.forget(sorted(runs))
    grown = add_tier1(events, lake.events, lake.quarantine)
    after = manifest.digests(other_partitions(before, grown).unionByName(grown))
    for (root, _), (merged, dates) in zip(_marts(lake), sums, strict=True):
        write_tier2(merged, root)
        Stamps(spark, root).add(dates.join(after, "date"))
    _count_lines(spark, lake, sorted(runs))
    ledger.record(files.where(F.col("run_date").isin(sorted(runs))))
    return sorted(runs)


def _added(spark: SparkSession, mart: Mart, events: DataFrame, digests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A mart's rows with those of further events, for the dates that have such and are up to date; and these dates."""
    root, operator = mart
    current = Stamps(spark, root).latest().join(digests, ["date", "digest"]).select("date")
    dates = _kept(spark, events.select(F.col("eventDate").alias("date")).distinct().join(current, "date"), "grown-dates")
    more = operator(events.join(dates, events["eventDate"] == dates["date"], "left_semi"))
    days = [row["date"] for row in dates.collect()]
    held = read_dates(spark, root, days, stored(more.schema)).select(more.columns)
    keys = [name for name in more.columns if name not in _SUMS]
    totals = [F.sum(name).alias(name) for name in more.columns if name in _SUMS]
    merged = held.unionByName(more).groupBy(*keys).agg(*totals).select(more.columns)
    return _kept(spark, merged, "merged"), dates


def _count_lines(spark: SparkSession, lake: Lake, runs: Sequence[Day]) -> None:
    """Store, per vendor and run day, how many lines became events and how many have which fault.

    Counted from what is stored, without parsing a line again: a line is an event, or unreadable, or without application.
    Lines read in part are events as well.
    """
    manifest = Manifest(spark, lake.events)
    stored_events = read_runs(spark, lake.events, manifest.of_runs(runs), TIER1_STORED)
    kinds = stored_events.select("tracking", "run_date", F.lit("events").alias("kind")).unionByName(
        read_quarantine(spark, lake.quarantine, runs).select("tracking", "run_date", F.col("fault").alias("kind"))
    )
    counts = kinds.groupBy("tracking", "run_date").agg(
        *(F.count_if(F.col("kind") == kind).alias(kind) for kind in ("events", *FAULTS))
    )
    lines = F.col("events") + F.col("unreadable") + F.col("no_app")
    for run in runs:  # a run that has no lines any more has no counts either
        delete(spark, f"{lake.raw_quality}/run_date={run}")
    (
        counts.withColumn("lines", lines).select(*RAW_QUALITY.names).coalesce(1)
        .write.partitionBy("run_date").mode("append").parquet(lake.raw_quality)
    )




def _marts(lake: Lake) -> list[Mart]:
    return [(lake.event_by_user, event_by_user), (lake.purchase_by_user, purchase_by_user)]


def _kept(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """Rows as they are now, whatever happens to the tables they come from."""
    path = shared_folder(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _build(spark: SparkSession, lake: Lake, mart: Mart, dates: DataFrame) -> None:
    """Build some dates (date, digest) of a mart from the events; only their folders are read.

    The digests are from before the events are read. So if a write comes in between, the stamp is the older one and the date
    stays stale. What comes to the driver is a list of days.
    """
    root, operator = mart
    days = [row["date"] for row in dates.select("date").collect()]
    if days:
        write_tier2(operator(read_dates(spark, lake.events, days, TIER1_STORED)), root, days)
    Stamps(spark, root).add(dates)


def _build_range(spark: SparkSession, lake: Lake, mart: Mart, start: Day, end: Day) -> None:
    """Dates in range that have events or that the mart holds, all of them (also rows without a date) without a range."""
    now, then = Manifest(spark, lake.events).digests(), Stamps(spark, mart[0]).latest()
    gone = then.join(now, then["date"].eqNullSafe(now["date"]), "left_anti").where("digest IS NOT NULL")
    dates = now.unionByName(gone.select("date", F.lit(None).cast("string").alias("digest")))
    _build(spark, lake, mart, _kept(spark, dates.where(between_dates("date", start, end)), "dates"))


def build_event_by_user(
    spark: SparkSession, lake: Lake, start: Day = None, end: Day = None
) -> None:
    """Event mart of all event dates in range."""
    _build_range(spark, lake, _marts(lake)[0], start, end)


def build_purchase_by_user(
    spark: SparkSession, lake: Lake, start: Day = None, end: Day = None
) -> None:
    """Purchase mart of all event dates in range."""
    _build_range(spark, lake, _marts(lake)[1], start, end)


def refresh_marts(spark: SparkSession, lake: Lake, also: Sequence[Day] = ()) -> None:
    """Rebuild, in each mart, the event dates that were built from other events than those there are now.

    So late events reach dates whose mart exists already, and a date that no run fills any more loses its rows, whichever job
    changed the events and however it ended. ``also`` names further dates to rebuild.
    """
    now = _kept(spark, Manifest(spark, lake.events).digests(), "digests")
    named = spark.createDataFrame([(as_date(day),) for day in also], "date DATE")
    for mart in _marts(lake):
        dates = stale(now, Stamps(spark, mart[0]).latest())
        if also:
            wanted = named.join(now, named["date"].eqNullSafe(now["date"]), "left").select(named["date"], "digest")
            dates = dates.unionByName(wanted).distinct()
        _build(spark, lake, mart, _kept(spark, dates, "stale-dates"))


def process_runs(
    spark: SparkSession, lake: Lake, runs: Sequence[Day], tz: str = "UTC", also: Sequence[Day] = (), lease: float = LEASE,
    only_new: bool = False,
) -> list[Day]:
    """Standardise run days, then rebuild both marts for every event date whose events have changed.

    Each day is claimed for ``lease`` seconds before anything changes, and let go when both marts are written. Days
    that another job is at are left to it; those an attempt before has begun with and not ended are done as well, so
    one that was cut short is made up for by the next one, whichever days that is for. ``also`` names further event
    dates to rebuild. With ``only_new``, days that have only got more files since they were stored take in just these;
    ``tz`` should then be what it was. Returns the run days that this job has done.
    """
    claims = Claims(spark, lake.due, lease)
    unfinished = set(claims.unfinished())
    wanted = {as_date(run) for run in runs} | unfinished
    mine = claims.take(wanted)
    if others := sorted(wanted - set(mine)):
        _LOG.warning("%d run days are left to other jobs, the first is %s", len(others), others[0])
    try:
        added = add_files(spark, lake, [run for run in mine if run not in unfinished], tz) if only_new else []
        standardize_days(spark, lake, [run for run in mine if run not in added], tz)
        refresh_marts(spark, lake, also)
    except BaseException:
        claims.let_go()
        raise
    claims.end()
    return mine


def new_runs(spark: SparkSession, lake: Lake, start: Day, end: Day) -> list[Day]:
    """Run days of a range whose raw files are not those their events were made from."""
    first, last = as_date(start), as_date(end)
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    due = Ledger(spark, lake.ledger).due(raw_files(spark, lake.raw, days), days)
    return sorted(row["run_date"] for row in due.collect())


def catch_up(spark: SparkSession, lake: Lake, start: str, end: str, tz: str = "UTC") -> list[Day]:
    """Bring all three tables up to date with the raw files of a range of run days.

    A day is done again if a file has changed or gone since it was done; if files have only come, such as further hours, just
    these are read, and their sums added to the marts. Event dates are rebuilt if their events changed, also by another job and outside the range. What an attempt before
    left undone is done as well. Returns the run days that were done.
    """
    return process_runs(spark, lake, new_runs(spark, lake, start, end), tz, only_new=True)
