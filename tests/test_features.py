"""The feature table against a plain-Python account of every column on random logs."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timezone
from statistics import mean

import pytest
from pyspark.sql import functions as F

from staypath.plans.content import content_features, popular_song_share, popularity_bar, song_popularity
from staypath.plans.features import dynamic_features, feature_table
from staypath.plans.labels import churn_label, churn_rate, label_checks, post_cancel_events
from staypath.plans.profile import list_one_hot, list_vocabulary, static_features
from staypath.plans.training import training_set
from staypath.plans.usage import usage_features
from staypath.operators.activity import activity
from staypath.schema import COUNTED_PAGES, DAY_PART_SHARES, DAY_PARTS
from tests.conftest import DAY, DEFAULTS, START, by_user

PAGES = ["NextSong"] * 5 + ["Thumbs Up", "Thumbs Down", "Add to Playlist", "Add Friend", "Error", "Cancel",
                            "Submit Downgrade", "Home", None]


def random_rows(seed, n=400):
    r = random.Random(seed)
    rows = []
    for number in range(n):
        user = r.choice(["a", "a", "a", "a", "b", "c", "d", "", None])
        song = r.random() < 0.7
        rows.append(DEFAULTS | {
            "userId": user, "auth": r.choice(["Logged In"] * 9 + ["Logged Out"]),
            "gender": r.choice(["F", "M", None]), "level": r.choice(["paid", "free", "free", None]),
            "registration": r.choice([None, START - 20 * DAY, START - 3 * DAY]),
            "ts": START + r.randrange(6 * DAY // 1000) * 1000, "sessionId": r.choice([1, 2, 3, 4, 5, None]),
            "itemInSession": number, "page": r.choice(PAGES),
            "artist": r.choice(["X", "Y", "Z", None]) if song else None,
            "song": r.choice(["s", "t", "u", "v", None]) if song else None,
            "length": r.choice([1.25, 2.5, 100.0, None]) if song else None,
            "userAgent": r.choice(["Mozilla/5.0 (X)", "Opera/9 like Gecko", None]),
        })
    return rows


def moment(ms):
    return datetime.fromtimestamp(ms / 1000, timezone.utc)


def part_of(ms):
    hour = moment(ms).hour
    return DAY_PARTS[0 if 1 <= hour <= 6 else 1 if 7 <= hour <= 12 else 2 if 13 <= hour <= 18 else 3]


def title(row):
    return None if row["artist"] is None or row["song"] is None else f"{row['artist']} - {row['song']}"


def span(rows):
    times = [row["ts"] for row in rows]
    return max(times) - min(times)


def grouped(rows, *keys):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(key(row) for key in keys)].append(row)
    return groups


def share(part, whole):
    return None if not whole else part / whole


def by_hand(rows, longest=None, shortest=None):
    active = [r for r in rows if r["auth"] == "Logged In"]
    today = moment(max(r["ts"] for r in active)).date()
    age = lambda r: (today - moment(r["ts"]).date()).days
    active = [r for r in active if (longest is None or age(r) <= longest) and (shortest is None or age(r) >= shortest)]
    active = [r for r in active if r["userId"] is not None]
    day, session = lambda r: moment(r["ts"]).date(), lambda r: r["sessionId"]
    plays = [r for r in active if r["page"] == "NextSong" and title(r) is not None]
    listeners = Counter(song for song, _ in {(title(r), r["userId"]) for r in plays})
    ordered = sorted(listeners.values())
    bar = ordered[(len(ordered) + 1) // 2 - 1] if ordered else None
    result = {}
    for (user,), mine in grouped(active, lambda r: r["userId"]).items():
        sessions, days = grouped(mine, session), grouped(mine, day)
        f = {
            "sessions": len(sessions), "items": len(mine), "active_days": len(days),
            "active_time": sum(span(s) for s in sessions.values()),
            "sessions_per_day": mean(len(grouped(d, session)) for d in days.values()),
            "time_per_day": mean(sum(span(s) for s in grouped(d, session).values()) for d in days.values()),
            "avg_items_per_session": mean(len(s) for s in sessions.values()),
            "time_per_session": mean(span(s) for s in sessions.values()),
        }
        times = Counter()
        for (part, _), piece in grouped(mine, lambda r: part_of(r["ts"]), session).items():
            times[part] += span(piece)
        for name, part in zip(DAY_PART_SHARES, DAY_PARTS):
            f[name] = share(times[part], sum(times.values()))
        f["unique_songs"] = len({title(r) for r in mine} - {None})
        f["unique_artists"] = len({r["artist"] for r in mine} - {None})

        def concentration(some, key):
            sums = [sum(r["length"] for r in g if r["length"] is not None)
                    for g in grouped(some, key).values() if any(r["length"] is not None for r in g)]
            return share(max(sums, default=0), sum(sums))

        f["max_song_perc"] = concentration(mine, title)
        mine_plays = [r for r in plays if r["userId"] == user]
        f["max_artist_perc"] = concentration(mine_plays, lambda r: r["artist"])
        for key, page in COUNTED_PAGES.items():
            f[f"numbers_{key}"] = sum(r["page"] == page for r in mine)
            if key != "error":
                f[f"perc_{key}"] = f[f"numbers_{key}"] / len(mine)
        f["perc_popular_songs"] = share(sum(listeners[title(r)] >= bar for r in mine_plays), len(mine_plays))
        last = max(mine, key=lambda r: (r["ts"], r["itemInSession"]))
        f["last_status_paid"] = int(last["level"] == "paid")
        statuses = {(day(r), r["level"] == "paid") for r in mine}
        f["paid_days"] = sum(paid for _, paid in statuses)
        f["perc_paid_days"] = f["paid_days"] / len(statuses)
        f["last_status_cancelled"] = int(last["page"] in ("Cancel", "Submit Downgrade"))
        result[user] = f
    return result


def same(got, want):
    assert got.keys() == want.keys()
    for user in want:
        for column, value in want[user].items():
            assert got[user][column] == (pytest.approx(value, rel=1e-12) if isinstance(value, float) else value), \
                (user, column)


@pytest.mark.parametrize("seed,window", [(1, ()), (2, ()), (3, (3, 1)), (4, (None, 2)), (5, (1,))])
def test_dynamic_features(make_log, seed, window):
    rows = random_rows(seed)
    table = dynamic_features(make_log(*rows), *window, max_artist_perc=True, label=True)
    same(by_user(table), by_hand(rows, *window))


@pytest.mark.parametrize("partitions", [1, 7])
def test_layout_does_not_matter(make_log, partitions):
    log = make_log(*random_rows(6))
    want = by_user(feature_table(log, agents=["Mozilla"], length_decimals=2))
    assert by_user(feature_table(log.repartition(partitions), agents=["Mozilla"], length_decimals=2)) == want


def test_invariants(make_log):
    log = make_log(*random_rows(7))
    table = by_user(feature_table(log))
    assert set(table) == {r["userId"] for r in log.select("userId").distinct().collect()} - {None}
    for row in table.values():
        if row["perc_1_6"] is not None:
            assert sum(row[s] for s in DAY_PART_SHARES) == pytest.approx(1)
        assert row["paid_days"] <= row["active_days"] and row["sessions"] <= row["items"]
        assert row["max_song_perc"] is None or 0 < row["max_song_perc"] <= 1


def test_columns_and_options(make_log):
    log = make_log({"location": "T, NY-NJ", "userAgent": "A.b/1 A_b/2 c"}, {"userId": "2", "auth": "Logged Out"})
    plain = feature_table(log)
    assert plain.columns == (
        "userId female customer_age agent_A_b agent_A_b_2 agent_Mozilla agent_c sessions items active_days active_time "
        "sessions_per_day time_per_day avg_items_per_session time_per_session perc_1_6 perc_6_12 perc_12_18 "
        "perc_18_1 unique_songs unique_artists max_song_perc numbers_thup numbers_thdn numbers_addlist "
        "numbers_addfrd numbers_error perc_thup perc_thdn perc_addlist perc_addfrd perc_popular_songs "
        "last_status_paid paid_days perc_paid_days"
    ).split()
    full = feature_table(log, states=True, max_artist_perc=True, active_day_share=True)
    assert set(full.columns) - set(plain.columns) == {"state_NJ", "state_NY", "max_artist_perc", "active_day_share"}
    rows = by_user(full)
    assert rows["1"]["active_day_share"] == 0.1 and rows["1"]["agent_A_b"] == rows["1"]["agent_A_b_2"] == 1
    assert rows["2"]["sessions"] is None and rows["2"]["customer_age"] == 10 and rows["2"]["agent_c"] == 0


# one small log per case where code, documentation and Spark's own rules pull apart

def test_zero_span_gives_null_shares(make_log):
    row = by_user(usage_features(activity(make_log({}))))["1"]
    assert all(row[s] is None for s in DAY_PART_SHARES) and row["active_time"] == 0


def test_log_without_plays(make_log):
    log = make_log({"page": "Home"}, {"page": "Home", "artist": "A", "song": "B", "length": 0.0, "userId": "2"})
    assert popularity_bar(song_popularity(activity(log))).first()["bar"] is None
    assert popular_song_share(activity(log)).count() == 0
    content = by_user(content_features(activity(log)))
    assert content["1"]["max_song_perc"] is None and content["2"]["max_song_perc"] is None
    assert content["2"]["unique_songs"] == 1 and content["2"]["max_artist_perc"] is None
    assert by_user(feature_table(log, agents=[]))["1"]["perc_popular_songs"] is None


def test_untitled_plays_weigh_in_total_only(make_log):
    log = make_log(
        {"page": "NextSong", "artist": "A", "song": "B", "length": 10.0}, {"page": "NextSong", "length": 40.0},
        {"page": "Home", "artist": "A", "song": "B", "length": 10.0},
    )
    row = by_user(content_features(activity(log)))["1"]
    assert row["max_song_perc"] == pytest.approx(40 / 60) and row["unique_songs"] == 1


def test_two_genders_and_registrations_stay_one_row(make_log):
    log = make_log({"gender": "F"}, {"gender": None, "registration": START - 5 * DAY}, {"registration": None})
    rows = static_features(log).collect()
    assert len(rows) == 1 and (rows[0]["female"], rows[0]["customer_age"]) == (1, 10)


def test_missing_ids_do_not_multiply(make_log):
    log = make_log({"userId": None}, {"userId": None, "sessionId": 2}, {"userId": "x"}, {"userId": ""})
    assert sorted(by_user(feature_table(log))) == ["", "x"]


def test_ties_go_by_item_number(make_log):
    log = make_log(
        {"itemInSession": 2, "level": "paid", "page": "Cancel"}, {"itemInSession": 1}, {"itemInSession": None},
    )
    assert by_user(usage_features(activity(log)))["1"]["last_status_paid"] == 1
    assert by_user(churn_label(log))["1"]["last_status_cancelled"] == 1


def test_session_coming_back_to_a_part_next_day(make_log):
    hour = 3_600_000
    log = make_log(*[{"ts": START + h * hour} for h in (8, 9, 14, 24 + 9)])
    row = by_user(usage_features(activity(log)))["1"]
    assert row["perc_6_12"] == 1.0 and row["active_time"] == 25 * hour and row["time_per_day"] == 3 * hour


def test_mixed_day_counts_twice(make_log):
    row = by_user(usage_features(activity(make_log({"level": "paid"}, {}, {"ts": START + DAY, "level": "paid"}))))["1"]
    assert row["paid_days"] == 2 and row["perc_paid_days"] == pytest.approx(2 / 3) and row["active_days"] == 2


def test_missing_times(make_log):
    log = make_log({"ts": None, "level": "paid"}, {"ts": None, "userId": "2", "level": "paid"}, {"ts": START + 5})
    rows = by_user(usage_features(activity(log)))
    assert rows["1"]["last_status_paid"] == 0 and rows["1"]["active_days"] == 2
    assert rows["2"]["last_status_paid"] == 1 and rows["2"]["active_time"] is None


@pytest.mark.parametrize("counts,bar", [([1], 1), ([1, 2], 1), ([3, 1, 2], 2), ([4, 1, 2, 3], 2), ([5, 5, 5, 1], 5)])
def test_popularity_bar(spark, counts, bar):
    songs = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(counts)], "singer_song string, listeners bigint")
    assert popularity_bar(songs).first()["bar"] == bar
    assert popularity_bar(songs).first()["bar"] == \
        songs.agg(F.expr("int(percentile_disc(0.5) within group (order by listeners))")).first()[0]
    assert popularity_bar(songs, relative_error=0.25).first()["bar"] in counts


@pytest.mark.parametrize("hot_songs", [1, 3, 5, 10**9])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_hot_and_other_songs_give_one_result(spark, make_log, hot_songs, broadcast):
    rows = random_rows(10)
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, broadcast)
    try:
        got = by_user(popular_song_share(activity(make_log(*rows)), hot_songs=hot_songs))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    want = {u: {"perc_popular_songs": f["perc_popular_songs"]} for u, f in by_hand(rows).items()
            if f["perc_popular_songs"] is not None}
    assert {u: {"perc_popular_songs": r["perc_popular_songs"]} for u, r in got.items()} == want


def test_vocabularies(make_log):
    log = make_log({"userAgent": "B/1 (x) A"}, {"userAgent": None}, {"userId": None, "userAgent": "Z"})
    assert list_vocabulary(log, "userAgent") == ["A", "B"]
    assert list_one_hot(log, "userAgent").columns == ["userId", "agent_A", "agent_B"]


def test_label_and_rate(make_log):
    log = make_log(
        {"userId": "1", "page": "Submit Downgrade", "ts": START + 1}, {"userId": "1"},
        {"userId": "2", "page": "Cancel"}, {"userId": "2", "ts": START + 1},
        {"userId": "3", "page": "Home"}, {"userId": "3", "page": "Cancel", "auth": "Logged Out", "ts": START + 9},
        {"userId": "4", "page": None},
    )
    labels = churn_label(log)
    assert {u: r["last_status_cancelled"] for u, r in by_user(labels).items()} == {"1": 1, "2": 0, "3": 0, "4": 0}
    assert tuple(churn_rate(labels).first()) == (1, 4, 0.25)
    assert tuple(label_checks(labels).first()) == (4, 4)
    assert [r["userId"] for r in post_cancel_events(log).collect()] == ["2"]


def test_training_set(make_log):
    log = make_log(*random_rows(8), {"userId": "out", "auth": "Logged Out"})
    training = training_set(log, ("b",))
    want = {user: f["last_status_cancelled"] for user, f in by_hand(random_rows(8)).items() if user != "b"}
    assert {u: r["last_status_cancelled"] for u, r in by_user(training).items()} == want
    assert training.columns[-1] == "last_status_cancelled"
    assert all(v is not None for r in training.collect() for v in r)


def test_training_set_with_gap(make_log):
    rows = random_rows(9)
    got = by_user(training_set(make_log(*rows), feature_min_days=3, label_max_days=1))
    labels, features = by_hand(rows, 1), by_hand(rows, None, 3)
    assert {u: r["last_status_cancelled"] for u, r in got.items()} == \
        {u: f["last_status_cancelled"] for u, f in labels.items()}
    assert all(got[u]["items"] == features[u]["items"] for u in got if u in features)
