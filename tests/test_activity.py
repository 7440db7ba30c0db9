import datetime
import re

import pytest

from staypath.operators.activity import activity, events_before_last, in_window, newest_day
from tests.conftest import DAY, START


def test_projection(make_log):
    log = make_log(
        {"page": "NextSong", "artist": "A", "song": "B", "length": 3.5, "ts": START + 2 * DAY + 7 * 3_600_000},
        {"auth": "Logged Out", "ts": START + 9 * DAY},
        {"registration": None, "artist": "A"},
    )
    first, second = activity(log).orderBy("time", ascending=False).collect()
    assert first["singer_song"] == "A - B" and first["time_in_the_day"] == "6am ~ 12pm"
    assert first["event_date"] == datetime.date(2024, 1, 3) and first["days_since_registration"] == 12
    assert first["days_before_today"] == 0 and second["days_before_today"] == 2
    assert second["singer_song"] is None and second["days_since_registration"] is None


@pytest.mark.parametrize("longest,shortest,days", [
    (None, None, {0, 1, 2, 3, 4}), (2, None, {0, 1, 2}), (None, 3, {3, 4}), (3, 1, {1, 2, 3}), (2, 2, {2}), (0, 0, {0}),
])
@pytest.mark.parametrize("as_of", [None, "2024-01-05"])
def test_window_is_inclusive(make_log, longest, shortest, days, as_of):
    log = make_log(
        *[{"ts": START + d * DAY + ms} for d in range(5) for ms in (0, DAY - 1)],
        {"ts": None}, {"ts": START + 8 * DAY, "auth": "Logged Out"},
    )
    rows = activity(log, longest, shortest, as_of).where("time is not null").collect()
    assert {r["days_before_today"] for r in rows} == days and len(rows) == 2 * len(days)


def test_window_follows_a_zone_with_changing_offset(spark, make_log):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        hour = 3_600_000
        start = 1_710_046_800_000  # 2024-03-10 00:00 in New York, a day of 23 hours
        log = make_log(*[{"ts": start + h * hour} for h in range(-1, 24)])
        kept = activity(log, 1, 1).collect()
        assert len(kept) == 23 and all(r["days_before_today"] == 1 for r in kept)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_newest_day(make_log):
    log = make_log({"ts": START}, {"ts": START + DAY, "auth": "Logged Out"})
    row = log.limit(1).select(newest_day(log).alias("d"), newest_day(log, "2024-02-02").alias("e")).first()
    assert (row["d"], row["e"]) == (datetime.date(2024, 1, 1), datetime.date(2024, 2, 2))


def test_window_skips_row_groups(spark, tmp_path):
    path = str(tmp_path / "log")
    (
        spark.range(0, 400_000, 1, 4)
        .selectExpr("'Logged In' as auth", f"{START} + id * 10000 as ts", "'x' as page")
        .write.option("parquet.block.size", 1 << 16).parquet(path)
    )
    kept = in_window(spark.read.parquet(path), 4, 3)
    total = kept.groupBy().count()
    assert total.collect()[0][0] > 0
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"GreaterThanOrEqual\(ts,\d+\)", plan) and re.search(r"LessThan\(ts,\d+\)", plan)


def test_cancel_before_last(make_log):
    log = make_log(
        {"userId": "a", "page": "Cancel", "ts": START}, {"userId": "a", "page": "Home", "ts": START + 1},
        {"userId": "b", "page": "Cancel", "ts": START + 1}, {"userId": "b", "page": "Home", "ts": START},
        {"userId": "c", "page": "Cancel", "itemInSession": 1}, {"userId": "c", "page": "Home", "itemInSession": 2},
        *[{"userId": "d", "page": "Cancel"}] * 4,
        *[{"userId": "e", "page": "Cancel"}] * 3, {"userId": "e", "page": "Home", "ts": START + 1},
        {"userId": None, "page": "Cancel"}, {"userId": None, "ts": START + 1},
    )
    kept = events_before_last(activity(log)).groupBy("userId").count().collect()
    assert {r["userId"]: r["count"] for r in kept} == {"a": 1, "c": 1, "d": 3, "e": 3}


def test_many_copies_are_kept(spark, make_log):
    copies = make_log({"page": "Cancel"}).crossJoin(spark.range(25_001)).drop("id")
    assert events_before_last(activity(copies)).count() == 25_000


def test_past_day_does_not_see_later_events(make_log):
    log = make_log(*[{"ts": START + d * DAY} for d in range(5)])
    rows = activity(log, max_days=1, as_of="2024-01-03").collect()
    assert sorted(r["days_before_today"] for r in rows) == [0, 1]
    assert min(r["days_before_today"] for r in activity(log, as_of="2024-01-03").collect()) == 0


def test_junk_times_do_not_move_today(make_log):
    junk = [2**63 - 1, -(2**63), 253_402_300_800_000]
    log = make_log({"ts": START}, {"ts": START + DAY}, *[{"ts": t, "registration": t} for t in junk])
    rows = activity(log).collect()
    assert len(rows) == 5 and {r["days_before_today"] for r in rows} == {0, 1, None}
    assert {r["time"] for r in activity(log, 1).collect()} == {START, START + DAY}
    assert activity(make_log({"ts": None}), 1).count() == 0


def test_window_has_no_subquery(make_log):
    log = make_log({"ts": START})
    plan = activity(log, 20, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan
