"""Raw lines that are no events, or not whole ones: none is lost, each is counted once."""

from __future__ import annotations

import json

import pytest

from eventmart.plans.jobs import Lake, process_runs, standardize_days
from eventmart.schemas import RAW_QUALITY, TIER1_STORED
from eventmart.sources import read_quarantine, read_tier
from tests.tables import day, raw_line, rows_of, write_lines

RUN = day("2021-01-02")


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "raw"), str(tmp_path / "warehouse"))


def quality(spark, lake):
    return rows_of(spark.read.schema(RAW_QUALITY).parquet(lake.raw_quality))


def test_every_line_is_somewhere(spark, ansi, tmp_path, lake):
    partly = raw_line("ADBRIX", currency="KRW")
    lines = [raw_line("ADBRIX")] * 3 + [partly, '{"logTimeStamp": 16', "", "no json", raw_line("ADBRIX", package_name=None, price=["7"])]
    write_lines(tmp_path / "raw/thirdparty-adbrix/2021-01/02/00", lines)
    write_lines(tmp_path / "raw/thirdparty-singular/2021-01/02", [raw_line("SINGULAR"), raw_line("SINGULAR", app_name=[])])
    write_lines(tmp_path / "raw/thirdparty-branch/2021-01/02", ["broken"])
    standardize_days(spark, lake, [RUN])
    assert quality(spark, lake) == [
        ("ADBRIX", 7, 4, 2, 1, 1, RUN), ("BRANCH", 1, 0, 1, 0, 0, RUN), ("SINGULAR", 2, 1, 0, 1, 0, RUN),
    ]
    kept = read_quarantine(spark, lake.quarantine, [RUN])
    assert {(r.tracking, r.fault, r.line) for r in kept.where("fault != 'no_app'").collect()} == {
        ("ADBRIX", "partly_read", partly), ("ADBRIX", "unreadable", '{"logTimeStamp": 16'), ("ADBRIX", "unreadable", "no json"),
        ("BRANCH", "unreadable", "broken"),
    }
    nameless = [json.loads(r.line) for r in kept.where("fault = 'no_app'").orderBy("tracking").collect()]
    assert nameless[0]["trackingObject"]["price"] == ["7"] and "app_name" in nameless[1]["trackingObject"]
    events = read_tier(spark, lake.events, schema=TIER1_STORED)
    assert rows_of(events.groupBy("tracking").count()) == [("ADBRIX", 4), ("SINGULAR", 1)]
    assert events.where("activityParam LIKE '%trackingObject%'").count() == 0


def test_a_repeated_run_replaces_its_quarantine_and_counts(spark, tmp_path, lake):
    folder = tmp_path / "raw/thirdparty-adbrix/2021-01/02"
    write_lines(tmp_path / "raw/thirdparty-adbrix/2021-01/01", ["other run"])
    write_lines(folder, ["bad", raw_line("ADBRIX"), raw_line("ADBRIX", package_name=None)])
    process_runs(spark, lake, ["2021-01-01", RUN])
    write_lines(folder, [raw_line("ADBRIX")])
    process_runs(spark, lake, [RUN])
    assert quality(spark, lake) == [("ADBRIX", 1, 0, 1, 0, 0, day("2021-01-01")), ("ADBRIX", 1, 1, 0, 0, 0, RUN)]
    assert rows_of(read_quarantine(spark, lake.quarantine, ["2021-01-01", RUN]), "line", "run_date") == [("other run", day("2021-01-01"))]
