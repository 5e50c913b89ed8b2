"""Reading raw folders, writing and re-writing stored tables, compaction, missing days."""

from __future__ import annotations

import datetime as dt
import pathlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventmart.operators import standardize, with_partition_columns
from eventmart.plans.adapters import with_instants, with_wall_clocks
from eventmart.plans.jobs import (
    Lake,
    build_event_by_user,
    build_purchase_by_user,
    catch_up,
    process_runs,
    standardize_days,
)
from eventmart.plans.reports import REPORTS, report
from eventmart.schemas import EVENT_BY_USER, PURCHASE_BY_USER, TIER1, TIER1_STORED, stored
from eventmart.sources import (
    calendar,
    missing_days,
    read_raw,
    read_tier,
    relayout,
    shared_folder,
    write_sorted,
    write_tier1,
    write_tier2,
)
from tests.tables import at, day, events, raw_line, rows_of, user_mart, write_lines


def tier1(spark, root, *columns):
    return rows_of(read_tier(spark, str(root), schema=TIER1_STORED), *columns)


def stored_events(spark, *whens, **extra):
    return with_instants(events(spark, [{"when": w} | extra for w in whens]))


def partitions(root: pathlib.Path) -> list[str]:
    return sorted({str(p.parent.relative_to(root)) for p in root.rglob("*.parquet")})


# --- raw -------------------------------------------------------------------------------------------


def test_raw_days_hours_and_absent_vendors(spark, tmp_path):
    write_lines(tmp_path / "thirdparty-adbrix/2021-01/01", [raw_line("ADBRIX")])
    write_lines(tmp_path / "thirdparty-adbrix/2021-01/02/00", [raw_line("ADBRIX")] * 2)
    write_lines(tmp_path / "thirdparty-adbrix/2021-01/02/01", [raw_line("ADBRIX")])
    root = str(tmp_path)
    assert read_raw(spark, "BRANCH", root, ["2021-01-01"]) is None
    assert read_raw(spark, "ADBRIX", root, []) is None
    assert read_raw(spark, "ADBRIX", root, ["2021-01-01"]).count() == 1
    both = read_raw(spark, "ADBRIX", root, ["2021-01-01", day("2021-01-02"), "2021-01-03"])
    counts = both.groupBy("run_date").count()
    assert rows_of(counts) == [(day("2021-01-01"), 1), (day("2021-01-02"), 3)]


# --- tier 1 ----------------------------------------------------------------------------------------


def test_tier1_layout(spark, tmp_path):
    root = tmp_path / "event"
    frame = stored_events(spark, "2021-01-01 05:00:00", "2021-01-02 06:00:00")
    nameless = stored_events(spark, "2021-01-02 07:00:00", trackingId=None)
    write_tier1(frame.unionByName(nameless), str(root), "2021-01-02")
    assert partitions(root) == ["date=2021-01-01/run_date=2021-01-02", "date=2021-01-02/run_date=2021-01-02"]
    back = read_tier(spark, str(root))
    assert set(back.columns) == set(TIER1_STORED.names)
    assert rows_of(back, "eventDate", "date", "eventHour", "hour") == [
        (day("2021-01-01"), day("2021-01-01"), "05", "05"),
        (day("2021-01-02"), day("2021-01-02"), "06", "06"),
    ]
    assert rows_of(with_wall_clocks(back), "eventTimeStamp") == [
        (at("2021-01-01 05:00:00"),), (at("2021-01-02 06:00:00"),),
    ]


def test_a_rerun_replaces_its_rows_and_late_rows_survive(spark, tmp_path):
    root = str(tmp_path / "event")
    write_tier1(stored_events(spark, "2021-01-01 05:00:00"), root, "2021-01-01")
    second = stored_events(spark, "2021-01-02 05:00:00", "2021-01-01 23:00:00")
    write_tier1(second, root, "2021-01-02")
    write_tier1(second, root, "2021-01-02")
    write_tier1(stored_events(spark, "2021-01-01 06:00:00"), root, "2021-01-01")
    assert tier1(spark, root, "date", "hour", "run_date") == [
        (day("2021-01-01"), "06", day("2021-01-01")),
        (day("2021-01-01"), "23", day("2021-01-02")),
        (day("2021-01-02"), "05", day("2021-01-02")),
    ]


def test_a_rerun_that_lost_a_date_removes_it(spark, tmp_path):
    root = str(tmp_path / "event")
    unreadable = stored_events(spark, "2021-01-02 05:00:00").withColumn("eventDate", F.lit(None).cast("date"))
    write_tier1(stored_events(spark, "2021-01-01 05:00:00"), root, "2021-01-01")
    write_tier1(stored_events(spark, "2021-01-01 05:00:00", "2021-01-02 05:00:00"), root, "2021-01-02")
    write_tier1(stored_events(spark, "2021-01-02 05:00:00").unionByName(unreadable), root, "2021-01-02")
    assert tier1(spark, root, "date", "run_date") == [
        (None, day("2021-01-02")),
        (day("2021-01-01"), day("2021-01-01")),
        (day("2021-01-02"), day("2021-01-02")),
    ]


def test_one_big_day_is_split_over_files(spark, tmp_path):
    """A day that is nearly the whole run does not end up in one task."""
    big = spark.range(0, 60_000, 1, 16).select(
        *(
            F.lit(None).cast(f.dataType).alias(f.name)
            for f in TIER1
            if f.name not in ("trackingId", "cid", "eventDate", "eventHour")
        ),
        F.lit("app").alias("trackingId"),
        F.sha2(F.col("id").cast("string"), 512).alias("cid"),
        F.when(F.col("id") % 1000 == 0, day("2021-01-01")).otherwise(day("2021-01-02")).alias("eventDate"),
        F.lit("00").alias("eventHour"),
    )
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "1MB")
    try:
        root = tmp_path / "event"
        write_tier1(big, str(root), "2021-01-02")
    finally:
        spark.conf.set(advisory, before)
    files = [p for p in root.rglob("*.parquet") if "date=2021-01-02/" in str(p)]
    assert len(files) > 3
    assert spark.read.parquet(str(root)).count() == 60_000


def test_reading_a_table_nobody_wrote(spark, tmp_path):
    nothing = read_tier(spark, str(tmp_path / "none"), "2021-01-01", None, TIER1_STORED)
    assert nothing.count() == 0
    assert nothing.schema.names == TIER1_STORED.names


# --- tier 2, sorted files, old layout --------------------------------------------------------------


def test_tier2_replaces_whole_days(spark, tmp_path):
    root = str(tmp_path / "mart")
    write_tier2(user_mart(spark, [{}, {"event_date": "2021-01-02"}]), root)
    write_tier2(user_mart(spark, [{"event_date": "2021-01-02", "c_id": "u2"}]), root)
    back = read_tier(spark, root, schema=stored(EVENT_BY_USER))
    assert rows_of(back, "date", "event_date", "c_id") == [
        (day("2021-01-01"), day("2021-01-01"), "u1"), (day("2021-01-02"), day("2021-01-02"), "u2"),
    ]
    assert read_tier(spark, root, "2021-01-02", "2021-01-02").count() == 1


def test_sorted_write_is_in_order_and_spreads_a_hot_value(spark, tmp_path):
    frame = spark.range(0, 8_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") % 100).alias("k"),
        F.col("id").alias("n"),
    )
    path = tmp_path / "sorted"
    write_sorted(frame, str(path), "k", files=8)
    files = sorted(path.glob("*.parquet"))
    assert len(files) > 5
    pieces = [spark.read.parquet(str(f)).select("k", "n").collect() for f in files]
    values = [row.k for piece in pieces for row in piece]
    assert values == sorted(values)
    assert sorted(row.n for piece in pieces for row in piece) == list(range(8_000))
    assert sum(any(row.k == 50 for row in piece) for piece in pieces) >= 2


def test_sorted_write_passes_parquet_settings(spark, tmp_path):
    frame = spark.range(0, 50_000, 1, 2).select((F.col("id") % 7).alias("k"), "id")
    for name, settings in {
        "default": {},
        "plain": {"compression": "zstd", "dictionary": False, "row_group_bytes": 64 * 1024},
    }.items():
        write_sorted(frame, str(tmp_path / name), "id", files=1, **settings)
    default, plain = (
        pq.ParquetFile(next((tmp_path / name).glob("*.parquet"))).metadata for name in ("default", "plain")
    )
    assert (default.row_group(0).column(0).compression, plain.row_group(0).column(0).compression) == (
        "GZIP", "ZSTD",
    )
    assert default.row_group(0).column(0).has_dictionary_page
    assert not plain.row_group(0).column(0).has_dictionary_page
    assert default.num_row_groups == 1 < plain.num_row_groups


@pytest.mark.parametrize("times_as_text", [False, True])
def test_relayout(spark, tmp_path, times_as_text):
    src, dst = tmp_path / "old", str(tmp_path / "new")
    runs = {
        "2021-01-01": ["2021-01-01 05:00:00"],
        "2021-01-02": ["2021-01-01 23:00:00", "2021-01-02 05:00:00"],
    }
    for run, whens in runs.items():
        frame = with_partition_columns(events(spark, [{"when": w} for w in whens]))
        if times_as_text:
            frame = frame.withColumns({
                c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("logTimeStamp", "eventTimeStamp")
            })
        else:
            frame = with_instants(frame)
        frame.write.partitionBy("date").parquet(f"{src}/{run}")
    relayout(spark, str(src), dst)
    relayout(spark, str(src), dst)
    back = with_wall_clocks(read_tier(spark, dst, schema=TIER1_STORED))
    assert rows_of(back, "date", "run_date", "eventTimeStamp") == [
        (day("2021-01-01"), day("2021-01-01"), at("2021-01-01 05:00:00")),
        (day("2021-01-01"), day("2021-01-02"), at("2021-01-01 23:00:00")),
        (day("2021-01-02"), day("2021-01-02"), at("2021-01-02 05:00:00")),
    ]


def test_relayout_of_mixed_types_and_hour_folders(spark, ansi, tmp_path, caplog):
    """Times as text and as timestamps, amounts as text, a missing column, two formats in one folder, hours, a stray file."""
    src, dst = tmp_path / "old", str(tmp_path / "new")
    clock = with_partition_columns(events(spark, [{"when": "2021-01-01 05:00:00"}, {"when": "2021-01-02 06:00:00"}]))
    texts = clock.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("logTimeStamp", "eventTimeStamp")})
    texts = texts.withColumn("amount", F.lit("12.7")).drop("campaign", "date", "hour")
    times = with_instants(clock).drop("date", "hour")
    texts.write.parquet(f"{src}/2021-01-01/05")
    texts.withColumn("amount", F.lit("many")).write.parquet(f"{src}/2021-01-01/06")
    times.write.parquet(f"{src}/2021-01-02/date=2021-01-01")
    texts.write.parquet(f"{src}/2021-01-02/date=2021-01-02")
    times.write.parquet(f"{src}/2021-01-03/23")
    times.write.parquet(f"{src}/elsewhere")
    with caplog.at_level("WARNING"):
        relayout(spark, str(src), dst)
    assert any("files lie in no run folder" in message for message in caplog.messages)
    back = with_wall_clocks(read_tier(spark, dst, schema=TIER1_STORED))
    found = rows_of(back, "run_date", "date", "eventTimeStamp", "amount", "campaign")
    dates = [(day("2021-01-01"), at("2021-01-01 05:00:00")), (day("2021-01-02"), at("2021-01-02 06:00:00"))]
    wanted = []
    for run, amount, campaign in (
        (None, 1, ""), ("2021-01-01", 12, None), ("2021-01-01", None, None), ("2021-01-02", 1, ""), ("2021-01-02", 12, None),
        ("2021-01-03", 1, ""),
    ):
        wanted += [(run and day(run), *date, amount, campaign) for date in dates]
    assert found == sorted(wanted, key=lambda r: [(v is not None, v) for v in r])


def test_tier2_removes_days_without_rows(spark, tmp_path):
    root = str(tmp_path / "mart")
    days = ["2021-01-01", "2021-01-02", "2021-01-03"]
    write_tier2(user_mart(spark, [{}, {"event_date": "2021-01-02"}, {"event_date": "2021-01-05"}]), root)
    write_tier2(user_mart(spark, [{"event_date": "2021-01-02"}]), root, days)
    assert rows_of(read_tier(spark, root, schema=stored(EVENT_BY_USER)), "date") == [
        (day("2021-01-02"),), (day("2021-01-05"),),
    ]


def test_a_repeated_run_takes_back_what_it_no_longer_holds(spark, tmp_path):
    lake = Lake(str(tmp_path / "raw"), str(tmp_path / "warehouse"))
    folder = tmp_path / "raw/thirdparty-adbrix/2021-01/02"
    whens = ["2021-01-01 23:00:00", "2021-01-02 01:00:00"]
    write_lines(folder, [raw_line("ADBRIX", event_time=[seconds(w)]) for w in whens])
    process_runs(spark, lake, ["2021-01-02"])
    write_lines(folder, [raw_line("ADBRIX", event_time=[seconds(whens[1])])])
    process_runs(spark, lake, ["2021-01-02"])
    for root, shape in ((lake.event_by_user, EVENT_BY_USER), (lake.purchase_by_user, PURCHASE_BY_USER)):
        assert rows_of(read_tier(spark, root, schema=stored(shape)), "date") == [(day("2021-01-02"),)]


def test_a_run_that_lost_all_rows_is_emptied_and_one_without_raw_stays(spark, tmp_path):
    lake = Lake(str(tmp_path / "raw"), str(tmp_path / "warehouse"))
    days = [f"2021-01-0{d}" for d in (1, 2, 3)]
    for d in days[:2]:
        write_lines(
            tmp_path / f"raw/thirdparty-adbrix/2021-01/{d[-2:]}",
            [raw_line("ADBRIX", event_time=[seconds(f"{d} 10:00:00")])],
        )
    write_tier1(stored_events(spark, "2021-01-03 10:00:00"), lake.events, days[2])
    process_runs(spark, lake, days)
    write_lines(tmp_path / "raw/thirdparty-adbrix/2021-01/01", [raw_line("ADBRIX", package_name=None)])
    process_runs(spark, lake, days)
    left = [(day(days[1]),), (day(days[2]),)]
    assert tier1(spark, lake.events, "run_date") == left
    assert rows_of(read_tier(spark, lake.event_by_user, schema=stored(EVENT_BY_USER)), "date") == left


# --- days ------------------------------------------------------------------------------------------


def test_calendar(spark):
    assert rows_of(calendar(spark, "2020-12-31", "2021-01-02")) == [
        (day("2020-12-31"),), (day("2021-01-01"),), (day("2021-01-02"),),
    ]
    hours = rows_of(calendar(spark, "2021-01-01 22:00:00", "2021-01-02 00:00:00", "1 hour"))
    assert hours == [(at(f"2021-01-0{d} {h}:00:00"),) for d, h in ((1, 22), (1, 23), (2, "00"))]


def test_missing_days(spark):
    have = spark.createDataFrame([(day("2021-01-02"),), (day("2021-01-02"),), (None,)], "date date")
    assert rows_of(missing_days(spark, have, "2021-01-01", "2021-01-03")) == [
        (day("2021-01-01"),), (day("2021-01-03"),),
    ]
    assert missing_days(spark, have, "2021-01-02", "2021-01-02").count() == 0


def test_shared_folder_is_below_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(root + "/") and first != second


# --- jobs ------------------------------------------------------------------------------------------


def seconds(text: str) -> int:
    return int(at(text).replace(tzinfo=dt.timezone.utc).timestamp())


def test_jobs_and_reports_end_to_end(spark, tmp_path):
    lake = Lake(str(tmp_path / "raw"), str(tmp_path / "warehouse"))
    raw = tmp_path / "raw"
    first, late = seconds("2021-01-01 10:00:00"), seconds("2021-01-01 11:00:00")
    write_lines(raw / "thirdparty-adbrix/2021-01/01", [raw_line("ADBRIX", event_time=[first])])
    catch_up(spark, lake, "2021-01-01", "2021-01-03")
    assert tier1(spark, lake.events, "date", "run_date", "tracking") == [
        (day("2021-01-01"), day("2021-01-01"), "ADBRIX")
    ]

    # The next run brings another vendor and a late event, which reaches the mart of its date.
    write_lines(raw / "thirdparty-adbrix/2021-01/02", [raw_line("ADBRIX", event_time=[late])])
    write_lines(
        raw / "thirdparty-branch/2021-01/02",
        [raw_line("BRANCH", event_timestamp=[1000 * seconds("2021-01-02 09:00:00")])],
    )
    catch_up(spark, lake, "2021-01-01", "2021-01-03")
    catch_up(spark, lake, "2021-01-01", "2021-01-03")

    def users():
        return read_tier(spark, lake.event_by_user, schema=stored(EVENT_BY_USER))

    assert rows_of(users(), "date", "app_name", "event_hour", "event_count") == [
        (day("2021-01-01"), "shop.a", "10", 1),
        (day("2021-01-01"), "shop.a", "11", 1),
        (day("2021-01-02"), "shop-b", "09", 1),
    ]
    def bought():
        return read_tier(spark, lake.purchase_by_user, schema=stored(PURCHASE_BY_USER))

    assert rows_of(bought(), "date", "amount_total") == [(day("2021-01-01"), 42)]

    # Doing the same with the single jobs changes nothing.
    standardize_days(spark, lake, ["2021-01-01", "2021-01-02"])
    build_event_by_user(spark, lake)
    build_purchase_by_user(spark, lake, "2021-01-01", "2021-01-01")
    assert users().count() == 3 and bought().count() == 1

    sales = report(spark, lake, "daily_sales", "2021-01-01", "2021-01-31")
    assert [tuple(r) for r in sales.collect()] == [
        ("shop.a", "ATC001", day("2021-01-01"), 1, 42, 42.0)
    ]
    for name in REPORTS:
        extra = {
            "event_slice": {"condition": F.col("value") > 0},
            "slice_count": {"app": "shop.a", "hour": "10", "weekday": "Fri"},
        }.get(name, {})
        assert report(spark, lake, name, "2021-01-01", "2021-01-31", **extra).collect() is not None


def test_reports_come_in_reading_order(spark, tmp_path):
    lake = Lake(str(tmp_path / "raw"), str(tmp_path / "warehouse"))
    write_tier2(
        user_mart(spark, [
            {"c_id": c, "event_date": d}
            for c, d in (("a", "2021-01-01"), ("b", "2021-01-01"), ("b", "2021-01-02"))
        ]),
        lake.event_by_user,
    )
    shown = report(spark, lake, "active_days").collect()
    assert [r.event_day_count for r in shown] == [2, 1]


def test_standardising_stored_raw_has_the_stored_schema(spark, tmp_path):
    write_lines(tmp_path / "thirdparty-adbrix/2021-01/01", [raw_line("ADBRIX")])
    raw = read_raw(spark, "ADBRIX", str(tmp_path), ["2021-01-01"])
    assert standardize(raw, "ADBRIX").columns == [*TIER1.names, "run_date"]
