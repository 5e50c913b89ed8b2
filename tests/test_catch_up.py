"""What is done again, and what is not: deliveries, staleness, claims, and the work of a write."""

from __future__ import annotations

import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from eventmart.plans import jobs
from eventmart.plans.jobs import Lake, build_event_by_user, catch_up, process_runs, standardize_days
from eventmart.schemas import EVENT_BY_USER, PURCHASE_BY_USER, TIER1_STORED, stored
from eventmart.sources import Manifest, read_dates, read_tier, write_tier1, write_tier2
from eventmart.sources import files as files_module
from eventmart.sources import lake as lake_module
from eventmart.sources.claims import Claims
from tests.tables import day, raw_line, rows_of, user_mart, write_lines
from tests.test_lake import seconds, stored_events

RANGE = ("2021-01-01", "2021-01-02")
FOLDER = "raw/thirdparty-adbrix/2021-01/02"


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "raw"), str(tmp_path / "warehouse"))


def deliver(tmp_path, hour: str, *times: str, folder: str = FOLDER) -> None:
    write_lines(tmp_path / folder / hour, [raw_line("ADBRIX", event_time=[seconds(t)]) for t in times])


def tables(spark, lake) -> list[list[tuple]]:
    return [
        rows_of(read_tier(spark, root, schema=schema), *schema.names)
        for root, schema in (
            (lake.events, TIER1_STORED), (lake.event_by_user, stored(EVENT_BY_USER)), (lake.purchase_by_user, stored(PURCHASE_BY_USER)),
        )
    ]


def from_scratch(spark, lake, tmp_path) -> list[list[tuple]]:
    other = Lake(lake.raw, str(tmp_path / f"scratch-{time.time_ns()}"))
    process_runs(spark, other, RANGE)
    return tables(spark, other)


def test_hours_replaced_and_vanished_files(spark, tmp_path, lake):
    deliver(tmp_path, "00", "2021-01-02 00:10:00", "2021-01-01 23:59:00", "2021-01-02 00:20:00")
    assert catch_up(spark, lake, *RANGE) == [day("2021-01-02")]
    deliver(tmp_path, "01", *["2021-01-02 01:10:00"] * 4)
    assert catch_up(spark, lake, *RANGE) == [day("2021-01-02")]
    assert len(tables(spark, lake)[0]) == 7
    assert tables(spark, lake) == from_scratch(spark, lake, tmp_path)

    # The same name and length, another content: a date loses its only event.
    deliver(tmp_path, "00", "2021-01-02 00:10:00", "2021-01-02 00:11:00", "2021-01-02 00:20:00")
    later = time.time() + 10
    os.utime(tmp_path / FOLDER / "00/part.json", (later, later))
    assert catch_up(spark, lake, *RANGE) == [day("2021-01-02")]
    assert tables(spark, lake) == from_scratch(spark, lake, tmp_path)
    assert {row[9] for row in tables(spark, lake)[1]} == {"00", "01"}

    shutil.rmtree(tmp_path / FOLDER / "01")
    assert catch_up(spark, lake, *RANGE) == [day("2021-01-02")]
    held = tables(spark, lake)
    assert len(held[0]) == 3 and held == from_scratch(spark, lake, tmp_path)

    # Nothing has changed: nothing is written. Raw logs that were cleared altogether stay stored.
    marts = sorted(p.stat().st_mtime_ns for p in (tmp_path / "warehouse/tier2").rglob("date=*/*.parquet"))
    assert catch_up(spark, lake, *RANGE) == []
    shutil.rmtree(tmp_path / FOLDER)
    assert catch_up(spark, lake, *RANGE) == []
    assert sorted(p.stat().st_mtime_ns for p in (tmp_path / "warehouse/tier2").rglob("date=*/*.parquet")) == marts
    assert tables(spark, lake) == held


def test_each_hour_is_read_once_and_its_sums_are_added(spark, tmp_path, lake, monkeypatch):
    read, wrote = [], []
    read_paths, write = jobs.read_raw_paths, jobs.write_tier1
    monkeypatch.setattr(jobs, "read_raw_paths", lambda spark, vendor, paths: read.extend(paths) or read_paths(spark, vendor, paths))
    monkeypatch.setattr(jobs, "write_tier1", lambda *args, **more: wrote.append(more["runs"]) or write(*args, **more))

    deliver(tmp_path, "00", "2021-01-02 00:10:00", "2021-01-01 23:59:00")
    catch_up(spark, lake, *RANGE)
    assert len(wrote) == 1 and read == []
    for hour in range(1, 4):
        users = [{"event_time": [seconds(f"2021-01-02 {h:02}:10:00")]} for h in (0, hour, hour)] + [{"event_time": [seconds("2021-01-01 23:59:00")]}]
        lines = [raw_line("ADBRIX", **user) for user in users] + ["no json", raw_line("ADBRIX", package_name=None)]
        write_lines(tmp_path / FOLDER / f"{hour:02}", lines)
        (tmp_path / FOLDER / f"{hour:02}/part.json").rename(tmp_path / FOLDER / f"{hour:02}/part[{hour}]{{a}}.json")
        assert catch_up(spark, lake, *RANGE) == [day("2021-01-02")]
        assert len(read) == hour and f"/{hour:02}/" in read[-1]
    assert len(wrote) == 1
    held = tables(spark, lake)
    assert len(held[0]) == 2 + 3 * 4 and held == from_scratch(spark, lake, tmp_path)
    counts = rows_of(spark.read.parquet(lake.raw_quality), "events", "unreadable", "no_app", "lines")
    assert counts == [(14, 3, 3, 20)]
    assert catch_up(spark, lake, *RANGE) == [] and len(read) == 3


@pytest.mark.parametrize("step", ["add_tier1", "write_tier2", "_count_lines"])
def test_an_hour_cut_short_is_made_up_for(spark, tmp_path, lake, monkeypatch, step):
    deliver(tmp_path, "00", "2021-01-02 00:10:00", "2021-01-01 23:59:00")
    catch_up(spark, lake, *RANGE)
    deliver(tmp_path, "01", "2021-01-02 01:10:00", "2021-01-02 00:10:00")
    done = getattr(jobs, step)

    def cut_short(*args, **more):
        done(*args, **more)
        raise KeyboardInterrupt

    monkeypatch.setattr(jobs, step, cut_short)
    with pytest.raises(KeyboardInterrupt):
        catch_up(spark, lake, *RANGE)
    monkeypatch.setattr(jobs, step, done)
    assert catch_up(spark, lake, *RANGE) == [day("2021-01-02")]
    assert tables(spark, lake) == from_scratch(spark, lake, tmp_path)


def test_sums_are_added_only_to_dates_that_no_other_job_changes(spark, tmp_path, lake, monkeypatch):
    deliver(tmp_path, "00", "2021-01-02 00:10:00", "2021-01-01 23:59:00")
    catch_up(spark, lake, *RANGE)
    deliver(tmp_path, "01", "2021-01-02 01:10:00")
    other = "raw/thirdparty-adbrix/2021-01/01"
    deliver(tmp_path, "00", "2021-01-02 00:10:00", folder=other)
    add = jobs.add_tier1

    def and_another_job(*args, **more):
        monkeypatch.setattr(jobs, "add_tier1", add)
        grown = add(*args, **more)
        assert process_runs(spark, lake, ["2021-01-01"]) == [day("2021-01-01")]
        return grown

    monkeypatch.setattr(jobs, "add_tier1", and_another_job)
    assert process_runs(spark, lake, ["2021-01-02"], only_new=True) == [day("2021-01-02")]
    assert tables(spark, lake) == from_scratch(spark, lake, tmp_path)


def test_marts_follow_events_that_another_job_changed(spark, tmp_path, lake):
    deliver(tmp_path, "00", "2021-01-02 00:10:00", "2021-01-01 23:59:00")
    catch_up(spark, lake, *RANGE)
    deliver(tmp_path, "00", "2021-01-02 00:10:00")
    deliver(tmp_path, "01", "2021-01-02 01:10:00")
    standardize_days(spark, lake, ["2021-01-02"])
    assert len(tables(spark, lake)[1]) == 2
    assert catch_up(spark, lake, *RANGE) == []
    assert tables(spark, lake) == from_scratch(spark, lake, tmp_path)
    assert {row[10] for row in tables(spark, lake)[1]} == {day("2021-01-02")}

    # One mart alone is rebuilt in a range, and not again.
    write_tier1(stored_events(spark, "2021-01-01 09:00:00"), lake.events, "2021-01-05")
    build_event_by_user(spark, lake, "2021-01-01", "2021-01-01")
    before = tables(spark, lake)[1]
    assert len(before) == 3
    catch_up(spark, lake, *RANGE)
    assert tables(spark, lake)[1] == before and len(tables(spark, lake)[2]) == 2


def test_tables_from_before_there_were_manifests(spark, tmp_path, lake):
    write_tier1(stored_events(spark, "2021-01-01 09:00:00", "2021-01-03 09:00:00"), lake.events, "2021-01-03")
    write_tier2(user_mart(spark, [{"event_date": "2020-12-31"}]), lake.event_by_user)
    shutil.rmtree(Manifest(spark, lake.events).path)
    write_tier1(stored_events(spark, "2021-01-03 10:00:00"), lake.events, "2021-01-03")
    process_runs(spark, lake, [])
    events, users, _ = tables(spark, lake)
    assert [row[20] for row in events] == [day("2021-01-03")]
    assert [row[10] for row in users] == [day("2021-01-03")]


def test_interleaved_jobs_leave_each_other_their_days(spark, tmp_path, lake, monkeypatch):
    days = ("2021-01-01", "2021-01-02", "2021-01-03")
    for d in days:
        deliver(tmp_path, "00", f"{d} 10:00:00", folder=f"raw/thirdparty-adbrix/2021-01/{d[-2:]}")
    done = {}
    standardize = jobs.standardize_days

    def and_another_job(spark, lake, runs, tz):
        if "second" not in done:
            done["second"] = []
            done["second"] = process_runs(spark, lake, days[1:])
            assert sorted(os.listdir(lake.due)) == [f".{d}.1.crc" for d in days[:2]] + [f"{d}.1" for d in days[:2]]
        standardize(spark, lake, runs, tz)

    monkeypatch.setattr(jobs, "standardize_days", and_another_job)
    assert process_runs(spark, lake, days[:2]) == [day(d) for d in days[:2]]
    assert done["second"] == [day(days[2])]
    assert not os.path.exists(lake.due)
    assert [row[10] for row in tables(spark, lake)[1]] == [day(d) for d in days]


def test_claims_of_killed_jobs_run_out(spark, tmp_path):
    folder = str(tmp_path / "due")
    killed, next_one = Claims(spark, folder, lease=3600), Claims(spark, folder)
    assert killed.take(["2021-01-01"]) == [day("2021-01-01")]
    assert next_one.take(["2021-01-01"]) == [] and next_one.unfinished() == []

    dead = Claims(spark, folder, lease=-1)
    assert dead.take(["2021-01-02"]) == [day("2021-01-02")]
    assert next_one.unfinished() == [day("2021-01-02")]
    third = Claims(spark, folder)
    assert next_one.take(next_one.unfinished()) == [day("2021-01-02")]
    assert third.take(["2021-01-02"]) == []
    next_one.let_go()
    assert third.take(third.unfinished()) == [day("2021-01-02")]
    third.end()
    assert {name for name in os.listdir(folder) if not name.startswith(".")} == {"2021-01-01.1"}


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "a/b")
    assert files_module.create(spark, path, "one")
    assert not files_module.create(spark, path, "two")
    assert files_module.content(spark, path) == "one"
    assert files_module.content(spark, path + "c") == ""


@pytest.mark.parametrize("stored_runs", [2, 400])
def test_a_write_lists_only_what_it_fills(spark, tmp_path, monkeypatch, stored_runs):
    root, mart = str(tmp_path / "event"), str(tmp_path / "mart")
    event = stored_events(spark, "2021-01-01 05:00:00")
    runs = F.explode(F.sequence(F.lit(day("2022-01-01")), F.date_add(F.lit(day("2022-01-01")), stored_runs - 1)))
    write_tier1(event.withColumn("run_date", runs), root)
    dated = user_mart(spark, [{}]).withColumn("event_date", runs)
    write_tier2(dated, mart)

    listed = []
    for module in (lake_module, __import__("eventmart.sources.manifest", fromlist=["x"])):
        monkeypatch.setattr(module, "matching", lambda spark, pattern: listed.append(found := files_module.matching(spark, pattern)) or found)
    write_tier1(stored_events(spark, "2021-01-03 05:00:00", "2021-01-04 05:00:00"), root, "2022-01-02")
    write_tier2(user_mart(spark, [{"event_date": "2022-01-01"}]), mart, ["2022-01-01", "2022-01-02"])
    assert sum(map(len, listed)) == 3

    back = read_tier(spark, root, schema=TIER1_STORED)
    assert back.where("run_date = '2022-01-02'").select("date").distinct().count() == 2
    assert back.count() == stored_runs + 1
    assert read_tier(spark, mart, schema=stored(EVENT_BY_USER)).count() == stored_runs - 1
    few = read_dates(spark, root, ["2021-01-03", "2021-02-01"], TIER1_STORED)
    assert len(few.inputFiles()) == 1 and rows_of(few, "date", "run_date") == [(day("2021-01-03"), day("2022-01-02"))]
