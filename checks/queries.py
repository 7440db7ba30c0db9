"""One callable per operator of the inventory: ``(spark, sf_dir) -> DataFrame``."""

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.oracles import AGENTS, STATES
from staypath.functions.columns import days_until, event_day
from staypath.model import evaluate, fit, prepare, sampling, trees
from staypath.model.optimum import loss_gradient
from staypath.operators import explore, report
from staypath.operators.activity import activity
from staypath.operators.dictionary import dictionary, sparse_rows
from staypath.plans import content, labels
from staypath.plans.features import feature_table
from staypath.plans.profile import LISTS, list_one_hot, listed_values, static_features
from staypath.plans.state import DailyState, write_state
from staypath.plans.training import training_set
from staypath.plans.usage import usage_features
from staypath.schema import (
    ACTION_COLUMNS, DAY_PART_SHARES, LABEL, LABEL_PROFILE_COLUMNS, MEMBERSHIP_COLUMNS,
)
from staypath.sources import star, tables

# lengths in the driver's tables have two decimals
CENTS = 2
# days inside the driver's log: one to look back from, and one from which days are added to a state
PAST, LATER = "2024-01-20", "2024-01-21"


def _session(spark: SparkSession) -> None:
    """UTC days, and a shared folder only where the session names none and runs on one machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        tables.shared_folder(spark)
    except ValueError:
        if spark.sparkContext.master.startswith("local"):
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="staypath-"))


def _log(spark, sf_dir):
    """Behaviour columns only."""
    return star.event_log(spark, sf_dir, profile=False)


def _full(spark, sf_dir):
    return star.event_log(spark, sf_dir)


def _features(spark, sf_dir, *days, **options):
    return feature_table(
        _log(spark, sf_dir), *days, profile_log=_full(spark, sf_dir), agents=AGENTS, length_decimals=CENTS, **options
    )


def _training(spark, sf_dir, **days):
    return training_set(
        _log(spark, sf_dir), ("0",), profile_log=_full(spark, sf_dir), agents=AGENTS, length_decimals=CENTS, **days
    )


def _usage(*columns):
    return lambda spark, d: usage_features(activity(_log(spark, d))).select("userId", *columns)


def _content(*columns):
    return lambda spark, d: content.content_features(activity(_log(spark, d)), CENTS).select("userId", *columns)


def _new_path(spark):
    return f"{tables.shared_folder(spark)}/table-{uuid.uuid4().hex}"


def _activity(spark, d):
    events = activity(_full(spark, d))
    return events.withColumns({c: F.col(c).cast("string") for c in ("registration_date", "event_date")})


def _customer_ages(spark, d):
    age = days_until(F.expr("date'2024-02-01'"), event_day("registration"))
    return _full(spark, d).select("userId", age.alias("days_till_as_of")).distinct()


def _post_cancel(spark, d):
    return labels.post_cancel_events(_log(spark, d), ("userId", "sessionId", "itemInSession", "time", "page", "level"))


def _state(spark, d):
    path = _new_path(spark)
    write_state(_log(spark, d), path, length_decimals=CENTS, profile_log=_full(spark, d))
    return DailyState(spark, path)


def _from_state(*days, **options):
    return lambda spark, d: _state(spark, d).feature_table(*days, agents=AGENTS, **options)


def _state_by_days(spark, d):
    """The state of all but the last ten days first, then those days added to it."""
    path, log, full = _new_path(spark), _log(spark, d), _full(spark, d)
    cut = f"ts < unix_millis(timestamp'{LATER}')"
    write_state(log.where(cut), path, length_decimals=CENTS, profile_log=full.where(cut))
    write_state(log, path, first_day=LATER, length_decimals=CENTS, profile_log=full)
    return DailyState(spark, path).feature_table(agents=AGENTS)


def _dictionary(source):
    def query(spark, d):
        name = LISTS[source][0]
        return dictionary(listed_values(_full(spark, d), source), name).withColumnsRenamed({name: "value", "n": "users"})
    return query


def _sparse(source):
    """Positions and counts as text, which both engines write alike."""
    def query(spark, d):
        name, values = LISTS[source][0], tables.staged(listed_values(_full(spark, d), source))
        rows = sparse_rows(values, name, dictionary(values, name))
        return rows.selectExpr("userId", "size", "array_join(indices, ',') as positions", "array_join(transform(values, v -> int(v)), ',') as counts")
    return query


def _damaged_log(spark, d):
    """The log as JSON lines of which some are cut off, some hold a text for a number, and some are no JSON."""
    path = _new_path(spark)
    line = "to_json(struct(*))"
    damaged = f"""case itemInSession % 50
        when 0 then left({line}, 40) when 1 then replace({line}, '"ts":', '"ts":"late",\"was\":') when 2 then 'no event' else {line} end"""
    _full(spark, d).selectExpr(f"{damaged} as value").write.text(path)
    return tables.read_checked_log(spark, path)


def _reject_counts(spark, d):
    events, rejects = _damaged_log(spark, d)
    return rejects.groupBy("reason").agg(F.count("*").alias("n")).unionByName(events.agg(F.lit("event").alias("reason"), F.count("*").alias("n")))


def _csv_one_file(spark, d):
    path, features = _new_path(spark), _features(spark, d)
    tables.write_features_csv(features, path, files=1)
    return tables.read_features_csv(spark, path, features.schema)


def _preview(spark, d):
    events = _activity(spark, d)
    return explore.preview(events, keys=("userId", "time", "itemInSession"))


def _agent_onehot(spark, d):
    return list_one_hot(_full(spark, d), "userAgent", AGENTS)


def _event_log_json(spark, d):
    path = _new_path(spark)
    tables.write_event_log(_full(spark, d), path)
    return tables.read_event_log(spark, path)


def _features_csv(spark, d):
    path, features = _new_path(spark), _features(spark, d)
    tables.write_features_csv(features, path)
    return tables.read_features_csv(spark, path, features.schema)


def _training_parquet(spark, d):
    path = _new_path(spark)
    tables.write_features(_training(spark, d), path)
    return tables.read_features(spark, path)


def _label_balance(spark, d):
    return explore.count_by(_training(spark, d).withColumnRenamed(LABEL, "label"), "label")


def _label_profile(spark, d):
    training = _training(spark, d).withColumnRenamed(LABEL, "label")
    return explore.means_by(training, "label", LABEL_PROFILE_COLUMNS, decimals=6)


def _scored(spark, d):
    return _training(spark, d).select(F.col("perc_thdn").alias("score"), F.col(LABEL).alias("label"))


def _labelled(spark, d):
    return labels.churn_label(_log(spark, d)).where("userId <> '0'").withColumnRenamed(LABEL, "label")


def _resample(spark, d):
    drawn = sampling.resample(_labelled(spark, d), 3, 1)
    copies = drawn.groupBy("userId", "label").agg(F.count("*").alias("copies"))
    return copies.select("userId", "label", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))


def _train_test(spark, d):
    train, test = sampling.split(_labelled(spark, d), seed=prepare.SPLIT_SEED)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _data(spark, d):
    """Stored training set, assembled; the modelling jobs read it many times."""
    stored = tables.staged(_training(spark, d))
    return prepare.assemble(stored), prepare.feature_names(stored)


def _scaling(spark, d):
    """Deviations the scaler learns from the resampled training part."""
    data, names = _data(spark, d)
    train, _ = sampling.split(data, seed=prepare.SPLIT_SEED)
    deviations = prepare.fit_scaler(sampling.resample(train, 3, 1)).std.toArray()
    table = spark.createDataFrame(list(zip(names, map(float, deviations))), "feature string, value double")
    return table.select("feature", F.format_string("%.8e", "value").alias("deviation"))


def _scaled_train_test(spark, d):
    train, test = prepare.train_test(_data(spark, d)[0], 3, 1)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "label").agg(F.count("*").alias("n"))


MULTIPLIERS = (3.0, 2.0, 1.5, 1.0)


def _sampling_runs(estimator):
    """Three runs for each size of the minority class."""
    def query(spark, d):
        return fit.repeated_runs(_data(spark, d)[0], estimator(), MULTIPLIERS, 1, runs=3)
    return query


def _sampling_run_sizes(spark, d):
    return fit.run_sizes(*fit.drawn_runs(_data(spark, d)[0], MULTIPLIERS, 1, 3))


def _grid(estimator, values):
    def query(spark, d):
        data, _ = _data(spark, d)
        search = fit.tune(data, estimator(), fit.param_grid(estimator(), values), 3, 1)
        return evaluate.grid_report(spark, search.model)
    return query


def _searched(estimator, values):
    """Grid search, then curves and importances of the best model."""
    def query(spark, d):
        data, names = _data(spark, d)
        return fit.search_report(fit.tune(data, estimator(), fit.param_grid(estimator(), values), 3, 1), names)
    return query


def _final_runs(spark, d):
    """Ten runs each of the chosen and of the default boosted trees."""
    data, _ = _data(spark, d)
    runs = {name: fit.sampling_runs(data, estimator, 3, 1, runs=10) for name, estimator in (("final", fit.gbt(**fit.GBT_FINAL)), ("default", fit.gbt()))}
    final, default = (df.withColumn("model", F.lit(name)) for name, df in runs.items())
    return final.unionByName(default)


def _stored_rows(spark, d):
    """The stored training set with its label as ``label``, and the names of its features."""
    stored = tables.staged(_training(spark, d))
    return stored.withColumnRenamed(LABEL, "label"), prepare.feature_names(stored)


def _fitted_lr(spark, d):
    stored, names = _stored_rows(spark, d)
    train, _ = prepare.train_test(prepare.assemble(stored, "label"), 3, 1)
    model = fit.logistic_regression(tol=1e-10, maxIter=300).fit(train)
    drawn = sampling.resample(sampling.split(stored, seed=prepare.SPLIT_SEED)[0], 3, 1)
    return loss_gradient(model, drawn, names)


def _lr_optimum(spark, d):
    return _fitted_lr(spark, d).select("feature", (F.abs("gradient") < 1e-4).alias("at_optimum"))


def _tree_scores(spark, d):
    """Test rows that the node table of a model scores as the model does, and features it weighs alike."""
    stored, names = _stored_rows(spark, d)
    train, test = prepare.train_test(prepare.assemble(stored, "label"), 3, 1)
    rows = []
    for name, estimator in (("forest", fit.random_forest()), ("boosted", fit.gbt())):
        model = estimator.fit(train)
        boosted, nodes = name == "boosted", tables.staged(trees.tree_nodes(spark, model, names))
        own = evaluate.churn_score(model.transform(test)).select("userId", F.col("score").alias("own"))
        near = F.abs(F.col("own") - F.col("score")) < 1e-12
        scores = trees.scored_by_nodes(stored, nodes, boosted).join(own, "userId").agg(F.count("*").alias("n"), F.count_if(near).alias("n_equal"))
        known = evaluate.importance_table(spark, model, names).withColumnRenamed("score", "own")
        alike = F.abs(F.col("own") - F.coalesce("score", F.lit(0.0))) < 1e-12
        weights = known.join(trees.importances_of(nodes, boosted), "feature", "left").agg(F.count("*").alias("n"), F.count_if(alike).alias("n_equal"))
        rows += [df.select(F.lit(name).alias("model"), F.lit(part).alias("part"), "n", "n_equal") for part, df in (("scores", scores), ("importances", weights))]
    return reduce(DataFrame.unionByName, rows)


def _fit_lr(spark, d):
    return _fitted_lr(spark, d)


def _feature_importance(spark, d):
    data, names = _data(spark, d)
    train, _ = prepare.train_test(data, 3, 1)
    return evaluate.top_features(evaluate.importance_table(spark, fit.gbt(**fit.GBT_FINAL).fit(train), names))


def _model_curve(spark, d):
    data, _ = _data(spark, d)
    train, test = prepare.train_test(data, 3, 1)
    scored = evaluate.churn_score(fit.logistic_regression().fit(train).transform(test))
    return evaluate.roc_curve(scored)


def _registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "dataset_summary": lambda s, d: explore.dataset_summary(_log(s, d)),
        "page_counts": lambda s, d: explore.count_by(_log(s, d), "page"),
        "auth_counts": lambda s, d: explore.count_by(_log(s, d), "auth"),
        "top_songs": lambda s, d: explore.top_songs(_log(s, d)),
        "max_days_back": lambda s, d: explore.max_days_back(activity(_log(s, d))),
        "null_user_rows": lambda s, d: explore.rows_with_null(_full(s, d), "userId"),
        "activity": _activity,
        "activity_window": lambda s, d: activity(_log(s, d), 14, 3).select(
            "userId", "time", "page", "days_before_today"),
        "customer_ages": _customer_ages,
        "post_cancel_events": _post_cancel,
        "agent_tokens": lambda s, d: listed_values(_full(s, d), "userAgent"),
        "agent_onehot": _agent_onehot,
        "agent_onehot_fitted": lambda s, d: list_one_hot(_full(s, d), "userAgent"),
        "agent_onehot_other": lambda s, d: list_one_hot(_full(s, d), "userAgent", ["Chrome"], other=True),
        "events_of_user": lambda s, d: explore.events_of_user(activity(_log(s, d)), "7").select("userId", "time", "page", "level"),
        "agent_share": lambda s, d: explore.column_means(_agent_onehot(s, d)),
        "state_tokens": lambda s, d: listed_values(_full(s, d), "location"),
        "state_onehot": lambda s, d: list_one_hot(_full(s, d), "location", STATES),
        "static_profile": lambda s, d: static_features(_full(s, d), AGENTS, activity_log=_log(s, d)),
        "session_usage": _usage("sessions", "items", "active_time", "avg_items_per_session", "time_per_session"),
        "day_usage": _usage("active_days", "sessions_per_day", "time_per_day"),
        "time_of_day": _usage(*DAY_PART_SHARES),
        "song_variety": _content("unique_songs", "unique_artists"),
        "song_concentration": _content("max_song_perc"),
        "artist_concentration": _content("max_artist_perc"),
        "action_counts": _usage(*ACTION_COLUMNS),
        "song_popularity": lambda s, d: content.song_popularity(activity(_log(s, d))),
        "popular_songs": lambda s, d: content.popular_songs(content.song_popularity(activity(_log(s, d)))),
        "popular_song_share": lambda s, d: content.popular_song_share(activity(_log(s, d))),
        "membership": _usage(*MEMBERSHIP_COLUMNS),
        "churn_label": lambda s, d: labels.churn_label(_log(s, d)),
        "churn_rate": lambda s, d: labels.churn_rate(labels.churn_label(_log(s, d))),
        "label_checks": lambda s, d: labels.label_checks(labels.churn_label(_log(s, d))),
        "feature_table": _features,
        "feature_table_window": lambda s, d: _features(s, d, 20, 7),
        "feature_table_past": lambda s, d: _features(s, d, 10, as_of=PAST),
        "feature_table_fitted": lambda s, d: feature_table(
            _log(s, d), profile_log=_full(s, d), states=True, length_decimals=CENTS),
        "activity_past": lambda s, d: activity(_log(s, d), 5, 1, as_of=PAST).select("userId", "time", "page", "days_before_today"),
        "churn_label_past": lambda s, d: labels.churn_label(_log(s, d), 10, as_of=PAST),
        "state_feature_table": _from_state(),
        "state_feature_table_window": _from_state(20, 7),
        "state_feature_table_past": _from_state(10, as_of=PAST),
        "state_by_days": _state_by_days,
        "agent_dictionary": _dictionary("userAgent"),
        "state_dictionary": _dictionary("location"),
        "agent_vectors": _sparse("userAgent"),
        "state_vectors": _sparse("location"),
        "log_rejects": _reject_counts,
        "checked_log": lambda s, d: _damaged_log(s, d)[0],
        "features_csv_one_file": _csv_one_file,
        "sampling_run_sizes": _sampling_run_sizes,
        "popularity_bar": lambda s, d: content.popularity_bar(content.song_popularity(activity(_log(s, d)))),
        "popularity_bar_approx": lambda s, d: content.popularity_bar(content.song_popularity(activity(_log(s, d))), 1e-6),
        "feature_table_extended": lambda s, d: _features(
            s, d, states=STATES, max_artist_perc=True, active_day_share=True),
        "training_set": _training,
        "training_set_gap": lambda s, d: _training(s, d, feature_min_days=14, label_max_days=7),
        "null_audit": lambda s, d: explore.null_counts(_features(s, d), ["female", "customer_age"]),
        "null_age_users": lambda s, d: explore.rows_with_null(_features(s, d), "customer_age"),
        "feature_histogram": lambda s, d: report.feature_histogram(_features(s, d)),
        "null_columns": lambda s, d: report.columns_with_nulls(_features(s, d)),
        "threshold_shares": lambda s, d: report.threshold_shares(_features(s, d)),
        "label_balance": _label_balance,
        "label_profile": _label_profile,
        "roc_curve": lambda s, d: evaluate.roc_curve(_scored(s, d)),
        "pr_curve": lambda s, d: evaluate.pr_curve(_scored(s, d)),
        "auc": lambda s, d: evaluate.area_under_roc(_scored(s, d)),
        "resample": _resample,
        "train_test": _train_test,
        "event_log_json": _event_log_json,
        "features_csv": _features_csv,
        "training_parquet": _training_parquet,
        "scaling": _scaling,
        "log_preview": _preview,
        "scaled_train_test": _scaled_train_test,
        "sampling_runs": _sampling_runs(fit.random_forest),
        "sampling_runs_gbt": _sampling_runs(fit.gbt),
        "sampling_runs_lr": _sampling_runs(fit.logistic_regression),
        "cv_gbt": _grid(fit.gbt, fit.GBT_GRID),
        "cv_rf": _grid(fit.random_forest, fit.FOREST_GRID),
        "searched_gbt": _searched(fit.gbt, fit.GBT_GRID),
        "searched_rf": _searched(fit.random_forest, fit.FOREST_GRID),
        "final_runs": _final_runs,
        "tree_scores": _tree_scores,
        "lr_optimum": _lr_optimum,
        "fit_lr": _fit_lr,
        "model_curve": _model_curve,
        "feature_importance": _feature_importance,
    }


def _prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _session(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _prepared(query) for name, query in _registry().items()}
