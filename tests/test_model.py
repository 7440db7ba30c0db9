import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from staypath.model import evaluate, fit, prepare, sampling


@pytest.fixture(scope="module")
def training(spark):
    """Noisy but learnable: churn grows with x."""
    rows = spark.range(600).selectExpr(
        "string(id) as userId", "double(id % 50) as x", "double(pmod(xxhash64(id), 100)) as noise",
        f"int(pmod(xxhash64(id, 7), 100) < id % 50) as last_status_cancelled",
    )
    return rows.cache()


@pytest.fixture(scope="module")
def data(training):
    return prepare.assemble(training).cache()


def test_poisson_steps():
    steps = sampling.poisson_steps(3.01)
    assert steps[0] == pytest.approx(math.exp(-3.01)) and steps == sorted(steps) and 1 - steps[-1] < 1e-10


def test_draws_are_even_and_seeded(spark):
    rows = spark.range(20_000).selectExpr(
        "id", f"{sampling.uniform_sql('id', 'split', 1)} as u", f"{sampling.uniform_sql('id', 'split', 2)} as w"
    )
    mean, low, high, corr = rows.selectExpr("avg(u)", "min(u)", "max(u)", "corr(u, w)").first()
    assert abs(mean - 0.5) < 0.01 and low >= 0 and high < 1 and abs(corr) < 0.03


def test_resample_sizes(spark):
    df = spark.range(40_000).selectExpr("string(id) as userId", "int(id % 4 = 0) as label")
    counts = {r["label"]: r["count"] for r in sampling.resample(df, 3, 0.5).groupBy("label").count().collect()}
    assert counts[1] == pytest.approx(30_100, rel=0.03) and counts[0] == pytest.approx(14_700, rel=0.03)
    copies = sampling.resample(df, 3, 0.5).where("label = 1").groupBy("userId").count()
    spread = copies.selectExpr("avg(count)", "max(count)").first()
    assert 3.0 < spread[0] < 3.4 and spread[1] > 6  # mean of a Poisson draw without its zeros
    assert sampling.resample(df, 3, 0.5).where("label = 0").groupBy("userId").count().where("count > 1").count() == 0


def test_resample_without_jitter_keeps_rows(data):
    drawn = sampling.resample(data, 1, 1, jitter=0)
    assert sorted(r["userId"] for r in drawn.collect()) == sorted(r["userId"] for r in data.collect())
    assert drawn.columns == data.columns


def test_resample_other_label_column(spark):
    df = spark.range(1000).selectExpr("string(id) as userId", "if(id % 2 = 0, 5, 6) as kind")
    drawn = sampling.resample(df, 2, 1, "kind", 6).groupBy("kind").count().collect()
    counts = {r["kind"]: r["count"] for r in drawn}
    assert counts[6] > 900 and counts[5] <= 500


def test_same_rows_for_any_layout(data):
    one = [r["userId"] for r in sampling.resample(data.repartition(1), 3, 1).orderBy("userId").collect()]
    many = [r["userId"] for r in sampling.resample(data.repartition(9), 3, 1).orderBy("userId").collect()]
    assert one == many
    other = [r["userId"] for r in sampling.resample(data, 3, 1, seed=1).orderBy("userId").collect()]
    assert other != one


def test_split_is_a_partition(data):
    train, test = sampling.split(data)
    a, b = {r["userId"] for r in train.collect()}, {r["userId"] for r in test.collect()}
    assert not a & b and len(a | b) == 600 and 0.62 < len(a) / 600 < 0.78


def test_train_test_scales_by_training_deviation(data):
    train, test = prepare.train_test(data, 2, 1)
    raw = np.array([r["features"].toArray() for r in train.collect()])
    scaled = np.array([r["scaledFeatures"].toArray() for r in train.collect()])
    assert scaled.std(axis=0, ddof=1) == pytest.approx([1, 1])
    assert scaled == pytest.approx(raw / raw.std(axis=0, ddof=1))
    row = test.first()
    assert row["scaledFeatures"].toArray() == pytest.approx(row["features"].toArray() / raw.std(axis=0, ddof=1))
    users = {r["userId"] for r in train.collect()} & {r["userId"] for r in test.collect()}
    assert not users


def test_curves_and_area(spark):
    scores = [(0.9, 1), (0.8, 0), (0.8, 1), (0.5, 1), (0.3, 0), (0.3, 0), (1.0, 1), (0.0, 0), (None, 1)]
    df = spark.createDataFrame(scores, "score double, label int")
    roc = [tuple(r) for r in evaluate.roc_curve(df).orderBy(F.desc("threshold")).collect()]
    assert [(x, y) for _, x, y in roc] == [(0, .25), (0, .5), (.25, .75), (.25, 1), (.75, 1), (1, 1)]
    pr = [tuple(r)[1:] for r in evaluate.pr_curve(df).orderBy(F.desc("threshold")).collect()]
    assert pr[2] == (0.75, 0.75) and pr[-1] == (1.0, 0.5)
    pairs = [(p > n) + (p == n) / 2 for p, a in scores for n, b in scores if a == 1 and b == 0 and p is not None]
    assert evaluate.area_under_roc(df).first()["auc"] == pytest.approx(sum(pairs) / len(pairs))
    assert evaluate.area_under_roc(df.where("label = 1")).first()["auc"] is None


def test_sampling_runs(data):
    runs = fit.sampling_runs(data, fit.logistic_regression(), 2, 1, runs=2).collect()
    assert [r["run"] for r in runs] == [0, 1] and all(0.6 < r["auc"] <= 1 for r in runs)
    assert (runs[0]["n_pos"], runs[0]["n_neg"]) != (runs[1]["n_pos"], runs[1]["n_neg"])
    assert fit.sampling_runs(data, fit.logistic_regression(), 2, 1, runs=2).collect() == runs


def test_grids():
    assert len(fit.param_grid(fit.gbt(), fit.GBT_GRID)) == 12
    assert len(fit.param_grid(fit.random_forest(), fit.FOREST_GRID)) == 4
    assert fit.gbt(**fit.GBT_FINAL).getMaxDepth() == 8
    assert fit.logistic_regression("scaledFeatures").getFeaturesCol() == "scaledFeatures"


@pytest.mark.parametrize("one_fold_per_key", [True, False])
def test_tune_and_report(spark, data, one_fold_per_key):
    forest = fit.random_forest(numTrees=3)
    grid = fit.param_grid(forest, {"maxDepth": [1, 4]})
    search = fit.tune(data, forest, grid, 2, 1, folds=2, one_fold_per_key=one_fold_per_key)
    report = evaluate.grid_report(spark, search.model).collect()
    assert sorted(r["params"] for r in report) == ["maxDepth=1", "maxDepth=4"] and sum(r["best"] for r in report) == 1
    assert search.model.getNumFolds() == 2
    assert search.predictions.count() == prepare.train_test(data, 2, 1)[1].count()
    last = search.roc.orderBy("threshold").first()
    assert (last["fpr"], last["tpr"]) == (1.0, 1.0) and search.pr.count() == search.roc.count()


def test_importances(spark, training, data):
    names = prepare.feature_names(training)
    assert names == ["x", "noise"]
    tree = evaluate.importance_table(spark, fit.random_forest(numTrees=5).fit(data), names)
    assert evaluate.top_features(tree, 1).first()["feature"] == "x"
    assert sum(r["score"] for r in tree.collect()) == pytest.approx(1)
    assert evaluate.importance_table(spark, fit.logistic_regression().fit(data), names).count() == 2


@pytest.mark.parametrize("low,high", [(0.0, 0.0005), (0.0, 10_000.0), (-5.0, 5.0)])
def test_curves_are_exact_for_scores_of_any_size(spark, low, high):
    rows = spark.range(5000).selectExpr(f"{low} + rand(3) * {high - low} as score", "rand(4) as r").selectExpr(
        "score", f"int(r < 0.2 + 0.6 * (score - {low}) / {high - low}) as label").cache()
    scored = rows.toPandas()
    order = scored.sort_values("score")
    ranks = np.arange(1, len(order) + 1)
    positive = order.label.to_numpy() == 1
    n = positive.sum()
    exact = (ranks[positive].sum() - n * (n + 1) / 2) / (n * (len(order) - n))
    assert evaluate.area_under_roc(rows).first()["auc"] == pytest.approx(exact, abs=1e-12)
    assert evaluate.roc_curve(rows).count() == scored.score.nunique() == evaluate.pr_curve(rows).count()


def test_no_task_orders_all_scores(spark):
    scored = spark.range(20_000).selectExpr("id / 20000 as score", "int(id % 3 = 0) as label")
    sizes = evaluate.score_totals(scored)
    plan = sizes._jdf.queryExecution().executedPlan().toString()
    ordered = [line for line in plan.splitlines() if "Window" in line and "threshold" in line.split("windowspec")[1]]
    assert ordered and all("[part" in line for line in ordered)


def test_split_sample_and_fold_draw_apart(spark):
    df = spark.range(20_000).selectExpr("string(id) as userId", "1 as label")
    train, _ = sampling.split(df, seed=7)
    drawn = sampling.resample(train, 3, 1, seed=7).count() / train.count()
    assert drawn == pytest.approx(3.01, rel=0.03)
    fold = f"int(floor({sampling.uniform_sql('userId', 'fold', 0)} * 2))"
    sizes = [r["count"] for r in sampling.resample(df, 3, 1, seed=0).selectExpr(f"{fold} as fold").groupBy("fold").count().collect()]
    assert len(sizes) == 2 and max(sizes) / min(sizes) < 1.1


def test_rows_without_key_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "userId string, label int")
    train, test = sampling.split(df)
    assert train.count() + test.count() == 3


def test_runs_fit_at_once(data):
    """Fits that run side by side give what they give one after another."""
    one = fit.repeated_runs(data, fit.logistic_regression(), [2, 1], 1, runs=2, parallelism=1).orderBy("multiplier", "run").collect()
    four = fit.repeated_runs(data, fit.logistic_regression(), [2, 1], 1, runs=2, parallelism=4).orderBy("multiplier", "run").collect()
    assert len(one) == 4 and four == one
