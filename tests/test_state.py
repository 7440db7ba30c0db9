"""Features from the stored daily state against features from the raw log."""

import random

import pytest

from staypath.plans.features import feature_table
from staypath.plans.state import DailyState, write_state
from tests.conftest import DAY, START, by_user

HOUR = 3_600_000
WINDOWS = [(None, None, None), (3, None, None), (None, 2, None), (5, 1, None), (None, None, "2024-01-04"), (2, 1, "2024-01-05"), (3, None, "2024-01-02"), (1, 0, "2023-01-01")]


def rows(seed, days=8, n=260):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        ts = START + rng.randrange(days * 24) * HOUR + rng.randrange(HOUR)
        song = rng.random() < 0.6
        out.append({
            "userId": rng.choice(["a", "b", "c", "d", "", None]), "auth": rng.choice(["Logged In"] * 6 + ["Logged Out"]),
            "gender": rng.choice(["F", "M", None]), "location": rng.choice(["T, A-B", "T, C", None, "X"]), "level": rng.choice(["free", "paid"]),
            "userAgent": rng.choice(["Mozilla/5 (x) Chrome/3", "Opera/1", None]), "registration": rng.choice([START - 9 * DAY, START - DAY, None]),
            # sessions of some hours, many over midnight
            "ts": ts, "sessionId": (ts - START + 5 * HOUR) // (9 * HOUR), "itemInSession": i,
            "page": rng.choice(["NextSong"] * 3 + ["Thumbs Up", "Error", "Cancel", "Home", None]) if song else rng.choice(["Home", "Cancel", "Submit Downgrade"]),
            "artist": rng.choice(["X", "Y", "Z"]) if song else None, "song": rng.choice(["s", "t", None]) if song else None,
            "length": round(rng.random() * 300, 2) if song else None,
        })
    return out + [{"userId": "junk", "ts": None}, {"userId": "junk", "ts": -10**17}, {"userId": "junk", "ts": 10**17, "song": "s", "artist": "X", "page": "NextSong"}]


@pytest.fixture(scope="module")
def log(make_log):
    return make_log(*rows(1)).cache()


@pytest.fixture(scope="module")
def path(log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("state"))
    write_state(log, path, length_decimals=2)
    return path


OPTIONS = {"agents": ["Chrome", "Opera"], "states": ["A", "C"], "max_artist_perc": True, "label": True, "active_day_share": True}


@pytest.mark.parametrize("window", WINDOWS)
def test_features_equal_those_of_the_log(spark, log, path, window):
    most, least, day = window
    want = feature_table(log, most, least, as_of=day, length_decimals=2, **OPTIONS)
    got = DailyState(spark, path).feature_table(most, least, as_of=day, **OPTIONS)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert by_user(got) == by_user(want)


def test_fitted_columns_equal_those_of_the_log(spark, log, path):
    assert DailyState(spark, path).feature_table(states=True).columns == feature_table(log, states=True, length_decimals=2).columns


def test_a_session_over_midnight_is_one(spark, make_log, tmp_path):
    log = make_log(*[{"ts": START + DAY + k * HOUR, "sessionId": 7, "level": "paid"} for k in (-2, -1, 0, 1, 2)])
    write_state(log, str(tmp_path), length_decimals=2)
    state = DailyState(spark, str(tmp_path))
    assert state.table("sessions").count() == 2
    row = state.feature_table(agents=[]).first()
    assert (row.sessions, row.items, row.active_days, row.active_time, row.time_per_session, row.paid_days) == (1, 5, 2, 4 * HOUR, 4.0 * HOUR, 2)
    assert row.time_per_day == 1.5 * HOUR


def test_a_window_reads_its_partitions_only(spark, path):
    state = DailyState(spark, path)
    folds = state.folds(3, 1)
    for frame in (folds.sessions, folds.plays):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: []" in plan
        assert sorted(f.split("event_date=")[1][:10] for f in frame.inputFiles()) and len(
            {f.split("event_date=")[1][:10] for f in frame.where("true").inputFiles()}) <= 10
    frame = state.table("sessions").where("event_date between date'2024-01-03' and date'2024-01-04'")
    assert frame.select("event_date").distinct().count() == 2


def test_days_are_added_and_replaced(spark, log, tmp_path):
    path = str(tmp_path)
    early = log.where(f"ts < {START + 4 * DAY}")
    write_state(early.where("userId <> 'b'"), path, length_decimals=2)
    write_state(early, path, first_day="2024-01-01", last_day="2024-01-04", length_decimals=2)  # late events of a user
    write_state(log, path, first_day="2024-01-05", length_decimals=2)
    write_state(log, path, first_day="2024-01-05", length_decimals=2)  # running again changes nothing
    valid = log.where(f"ts between {START} and {START + 30 * DAY}")
    got = DailyState(spark, path).feature_table(20, 0, **OPTIONS)
    known = by_user(feature_table(valid, 20, 0, length_decimals=2, **OPTIONS))
    assert {u: r for u, r in by_user(got).items() if u != "junk"} == known
    with pytest.raises(ValueError):
        write_state(log, path, first_day="2024-01-05", length_decimals=3)


def test_empty_log_and_other_time_zone(spark, make_log, tmp_path):
    write_state(make_log({"userId": "x"}).limit(0), str(tmp_path), length_decimals=2)
    state = DailyState(spark, str(tmp_path))
    for window in ((None, None), (3, 1)):
        assert state.feature_table(*window, agents=["A"]).count() == 0
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError):
            DailyState(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
