"""Encoding, exploration, reports, readers and writers."""

import numpy as np
import pytest

from staypath.operators import explore, report
from staypath.operators.encode import encoded_names, one_hot
from staypath.sources import tables
from staypath.plans.features import feature_table
from staypath.schema import EVENT_SCHEMA
from tests.conftest import by_user
from tests.test_features import random_rows


def test_one_hot_counts_by_other_columns(spark):
    df = spark.createDataFrame(
        [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (1, "b", None), (2, "a", "x.z")], "userId bigint, k string, v string"
    )
    wide = one_hot(df, "v")
    assert wide.columns == ["userId", "k", "v_x", "v_x_z", "v_y"]
    assert sorted(map(tuple, wide.collect())) == [(1, "a", 2, 0, 1), (1, "b", 0, 0, 0), (2, "a", 0, 1, 0)]
    assert one_hot(df, "v", ["y", "q"]).columns == ["userId", "k", "v_y", "v_q"]
    assert sorted(map(tuple, one_hot(df, "v", []).collect())) == [(1, "a"), (1, "b"), (2, "a")]


def test_encoded_names_stay_apart():
    names = encoded_names("agent", ["a.b", "a_b", "A(b", "", "sum(x)"])
    assert names == {"a.b": "agent_a_b", "a_b": "agent_a_b_2", "A(b": "agent_A_b_3", "": "agent_", "sum(x)": "agent_sum_x_"}


def test_summary_counts_missing_id_as_one_user(make_log, spark):
    log = make_log({"userId": None}, {"userId": None}, {"userId": "1"}, {"userId": "2"}, {"userId": "2"})
    assert tuple(explore.dataset_summary(log).first()) == (5, 2, 3)
    assert tuple(explore.dataset_summary(log.limit(0)).first()) == (0, 0, 0)


def test_counts_and_top_songs(make_log):
    log = make_log(*[{"artist": "A", "song": s} for s in "bbbaaac"], {"song": "q"}, {"artist": "only"}, {"page": None})
    assert [tuple(r) for r in explore.top_songs(log, 3).collect()] == [("A - a", 3), ("A - b", 3), (None, 1)]
    assert {r["page"]: r["n"] for r in explore.count_by(log, "page").collect()} == {"Home": 9, None: 1}


def test_null_counts_and_filters(make_log):
    log = make_log({"userId": None}, {"userId": "7", "artist": "A"}, {"userId": "7"}, {"userId": ""})
    assert explore.null_counts(log, ["userId", "artist"]).first().asDict() == {"userId": 1, "artist": 3}
    assert report.columns_with_nulls(log.select("userId", "artist", "ts")).first()[0] == 2
    assert explore.rows_with_null(log, "userId").count() == 1
    assert explore.events_of_user(log, 7).count() == 2
    assert explore.preview(log, 2).count() == 2


def test_means(spark):
    rows = [("u", 1, 0.125, 1), ("v", 0, 0.5, 1), ("w", 0, None, 0)]
    df = spark.createDataFrame(rows, "userId string, a int, b double, l int")
    assert explore.column_means(df, ["a", "b"]).first().asDict() == {"a": 0.33, "b": 0.31}
    assert explore.column_means(df).columns == ["a", "b", "l"]
    assert {r["l"]: r["mean_b"] for r in explore.means_by(df, "l", ["b"]).collect()} == {1: 0.3125, 0: None}


@pytest.mark.parametrize("bins", [1, 10, 7])
def test_histogram_equals_numpy(spark, bins):
    rng = np.random.default_rng(5)
    a, b = rng.gamma(2, 10, 500), rng.integers(0, 4, 500)
    rows = [(float(x), int(y), 3.0, None if i % 3 else float(x)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b bigint, same double, holes double")
    got = report.feature_histogram(df, ["a", "b", "same", "holes"], bins, hour_columns=[]).collect()
    assert len(got) == 4 * bins
    for name, values in {"a": a, "b": b, "same": [3.0] * 500, "holes": a[::3]}.items():
        counts, edges = np.histogram(values, bins)
        mine = sorted((r for r in got if r["feature"] == name), key=lambda r: r["bin"])
        assert [r["n"] for r in mine] == list(counts)
        assert [r["lower"] for r in mine] + [mine[-1]["upper"]] == pytest.approx(list(edges))


def test_histogram_of_nothing_and_of_hours(spark):
    df = spark.createDataFrame([(None, 3_600_000), (None, 7_200_000)], "a double, b bigint")
    got = report.feature_histogram(df, ["a", "b"], 2, hour_columns=["b"]).collect()
    assert sorted(map(tuple, got)) == [("b", 1, 1.0, 1.5, 1), ("b", 2, 1.5, 2.0, 1)]


def test_threshold_shares(spark):
    df = spark.createDataFrame(
        [(11, 1.0, 3.0 * 3_600_000, 1.0), (10, 1.1, 3.1 * 3_600_000, 0.9), (None, None, None, None), (0, 9.0, 0.0, 1.0)],
        "active_days int, sessions_per_day double, time_per_day double, perc_paid_days double",
    )
    assert tuple(report.threshold_shares(df).first()) == (0.25, 0.5, 0.25, 0.5)


def test_json_log_round_trip(spark, make_log, tmp_path):
    log = make_log(*random_rows(11, 50), {"userId": ""})
    tables.write_event_log(log, str(tmp_path / "log"))
    back = tables.read_event_log(spark, str(tmp_path / "log"))
    assert back.schema == log.schema
    assert sorted(map(str, back.collect())) == sorted(map(str, log.collect()))


def test_feature_files_round_trip(spark, make_log, tmp_path):
    features = feature_table(make_log(*random_rows(12, 60), {"userId": ""}), agents=["Mozilla"]).cache()
    want = by_user(features)
    tables.write_features(features, str(tmp_path / "p"))
    assert by_user(tables.read_features(spark, str(tmp_path / "p"))) == want
    tables.write_features_csv(features, str(tmp_path / "c"), files=1)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    assert by_user(tables.read_features_csv(spark, str(tmp_path / "c"), features.schema)) == want
    staged = tables.staged(features)
    assert staged.schema == features.schema and by_user(staged) == want
    assert "Exchange" not in staged._jdf.queryExecution().executedPlan().toString()


def test_rejected_lines_are_kept_apart(spark, tmp_path):
    lines = [
        '{"userId": "1", "ts": 5, "page": "Home"}', '{"userId": "2", "ts": "late"}', '{"userId": "3", "ts": 7', "no json", "[1, 2]", "", "   ",
        '{"userId": "4", "other": 1}', "{}", '{"userId": {"a": 1}, "length": "x"}', "7", "null", '{"ts": 1e3}',
    ]
    path = tmp_path / "log"
    path.mkdir()
    (path / "a.json").write_text("\n".join(lines) + "\n")
    events, rejects = tables.read_checked_log(spark, str(path))
    assert events.columns == EVENT_SCHEMA.names
    got = {(r.reason, r.line) for r in rejects.collect()}
    kept = [r.userId for r in events.collect()]
    assert ("type", lines[1]) in got and {("broken", x) for x in (lines[2], "no json")} <= got
    assert rejects.count() + events.count() == len([x for x in lines if x.strip()])
    assert {"1", "4"} <= set(kept) and "2" not in kept and "3" not in kept
    assert events.select("page").where("page is not null").count() == 1  # the same rows whichever columns are read
    assert {r.file for r in rejects.collect()} == {"a.json"}
    tables.write_rejects(rejects, str(tmp_path / "rejects"))
    tables.write_rejects(rejects, str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 2 * len(got)


@pytest.mark.parametrize("files", [1, 3, 50])
def test_csv_parts_are_joined(spark, tmp_path, files):
    df = spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, concat('a,\"b\" ', id)) as text", "id / 3 as x").repartition(9)
    path = str(tmp_path / "csv")
    tables.write_features_csv(df, path, files=files)
    names = [p.name for p in (tmp_path / "csv").glob("*.csv")]
    assert 1 <= len(names) <= min(files, 9) and [p.name for p in tmp_path.iterdir()] == ["csv"]
    back = tables.read_features_csv(spark, path, df.schema)
    assert back.count() == 1000
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}
    tables.write_features_csv(df.limit(0), path, files=files)
    assert tables.read_features_csv(spark, path, df.schema).count() == 0


def test_staged_tables_are_removed_together(spark):
    first, second = tables.staged(spark.range(5)), tables.staged(spark.range(7))
    assert (first.count(), second.count()) == (5, 7)
    kept = f"{tables.shared_folder(spark)}/kept"
    spark.range(3).write.parquet(kept)
    tables.clear_staged(spark)
    tables.clear_staged(spark)
    with pytest.raises(Exception):
        first.count()
    assert spark.read.parquet(kept).count() == 3 and tables.staged(spark.range(2)).count() == 2
