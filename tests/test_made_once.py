"""Queries that write the same rows several times make them once."""

from __future__ import annotations

import datetime as dt

import pytest

from eventmart.plans import queries


@pytest.fixture
def folder(spark, tmp_path):
    rows = [
        (i, dt.datetime(2024, 1, 1 + i % 3, i % 24, 5), i % 7, ("view", "purchase", "error")[i % 3], i + 0.5, f'{{"k": {i}}}')
        for i in range(40)
    ]
    schema = "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_a_run_written_again_is_parsed_once(spark, folder, monkeypatch):
    written, write = [], queries.write_tier1
    monkeypatch.setattr(queries, "write_tier1", lambda events, *rest: (written.append(plan(events)), write(events, *rest)))
    assert queries.tier1_write(spark, folder).count() == 108  # of 120 lines one in ten names no application
    assert len(written) == 2
    assert not any("from_json" in text for text in written)


def test_lines_of_a_delivery_are_made_once(spark, folder, monkeypatch):
    made, lines = [], queries.raw_lines
    monkeypatch.setattr(queries, "raw_lines", lambda *args: (made.append(args[2]), lines(*args))[1])
    users = queries.catch_up_marts(spark, folder)
    assert users.groupBy().sum("event_count").head()[0] == queries.standardized_logs(spark, folder).where("cid != ''").count()
    assert sorted(made) == ["ADBRIX", "BRANCH", "SINGULAR"]
