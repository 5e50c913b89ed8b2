"""Raw files that arrive in several deliveries."""

from __future__ import annotations

from eventmart.plans.jobs import Lake
from eventmart.schemas import EVENT_BY_USER, TIER1_STORED, stored
from eventmart.sources import read_tier
from eventmart.streaming import follow_raw_logs
from tests.tables import day, raw_line, rows_of, write_lines
from tests.test_lake import seconds


def test_deliveries_within_a_day(spark, tmp_path):
    lake = Lake(str(tmp_path / "raw"), str(tmp_path / "warehouse"))
    folder = tmp_path / "raw/thirdparty-adbrix/2021-01/02"

    def deliver(hour: str, when: str) -> None:
        write_lines(folder / hour, [raw_line("ADBRIX", event_time=[seconds(when)])])
        query = follow_raw_logs(spark, lake, str(tmp_path / "checkpoint"), files_per_batch=1)
        query.awaitTermination()

    def users() -> list[tuple]:
        mart = read_tier(spark, lake.event_by_user, schema=stored(EVENT_BY_USER))
        return rows_of(mart, "date", "event_hour", "event_count")

    deliver("00", "2021-01-02 00:30:00")
    assert users() == [(day("2021-01-02"), "00", 1)]
    deliver("01", "2021-01-01 23:50:00")
    deliver("02", "2021-01-02 00:40:00")
    assert users() == [(day("2021-01-01"), "23", 1), (day("2021-01-02"), "00", 2)]
    events = read_tier(spark, lake.events, schema=TIER1_STORED)
    assert rows_of(events, "date", "run_date") == [
        (day("2021-01-01"), day("2021-01-02")),
        (day("2021-01-02"), day("2021-01-02")),
        (day("2021-01-02"), day("2021-01-02")),
    ]
