"""Repeated evaluation and grid search over MLlib classifiers."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F
from pyspark.util import inheritable_thread_target

from staypath.model.evaluate import area_under_roc, churn_score, grid_report, pr_curve, roc_curve
from staypath.model.prepare import SPLIT_SEED, fit_scaler, train_test
from staypath.model.sampling import copies_sql, in_train_sql, repeated, uniform_sql
from staypath.model.trees import importances_of, tree_nodes
from staypath.sources.tables import staged


def gbt(features_col: str = "features", **params) -> GBTClassifier:
    return GBTClassifier(featuresCol=features_col, **params)


def random_forest(features_col: str = "features", **params) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features_col, **params)


def logistic_regression(features_col: str = "features", **params) -> LogisticRegression:
    return LogisticRegression(featuresCol=features_col, **params)


# The searched grids and the boosted trees used after the search.
GBT_GRID = {"maxDepth": [5, 8], "stepSize": [0.01, 0.05, 0.1], "subsamplingRate": [0.8, 1.0]}
FOREST_GRID = {"maxDepth": [5, 8], "subsamplingRate": [0.8, 1.0]}
GBT_FINAL = {"maxDepth": 8, "stepSize": 0.1}


def param_grid(estimator: Estimator, values: dict[str, list]) -> list:
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder = builder.addGrid(estimator.getParam(name), choices)
    return builder.build()


def sampling_runs(
    data: DataFrame, estimator: Estimator, minority_multiplier: float, majority_fraction: float, runs: int = 5, **options
) -> DataFrame:
    """Split, resample, fit and score ``runs`` times: ``run, n_pos, n_neg, auc``; see :func:`repeated_runs`."""
    return repeated_runs(data, estimator, [minority_multiplier], majority_fraction, runs, **options).drop("multiplier")


def drawn_runs(
    data: DataFrame,
    multipliers: Sequence[float],
    majority_fraction: float,
    runs: int,
    *,
    label_col: str = "label",
    minority_tag: int = 1,
    key: str = "userId",
    split_seeds: list[int] | None = None,
    sample_seeds: list[int] | None = None,
    jitter: float = 0.01,
) -> tuple[list[tuple[float, int]], DataFrame]:
    """(multiplier, run) of all draws, and ``data`` with ``copies``: how often each draw takes a row for training, null for a test row."""
    split_seeds = [SPLIT_SEED] * runs if split_seeds is None else split_seeds
    sample_seeds = list(range(runs)) if sample_seeds is None else sample_seeds
    draws, copies = [], []
    for multiplier in multipliers:
        for run, (split_seed, sample_seed) in enumerate(zip(split_seeds, sample_seeds, strict=True)):
            taken = copies_sql(multiplier, majority_fraction, label_col, minority_tag, key=key, seed=sample_seed, jitter=jitter)
            draws.append((float(multiplier), run))
            copies.append(F.expr(f"case when {in_train_sql(key=key, seed=split_seed)} then coalesce({taken}, 0) end"))
    return draws, data.withColumn("copies", F.array(*copies))


def run_sizes(draws: list[tuple[float, int]], drawn: DataFrame, label_col: str = "label", minority_tag: int = 1) -> DataFrame:
    """``multiplier, run, n_pos, n_neg`` of the training parts of all draws, in one pass."""
    of_class = f"{label_col} = {minority_tag}"
    sums = [
        F.struct(F.lit(m).alias("multiplier"), F.lit(run).alias("run"),
                 F.expr(f"coalesce(sum(case when {of_class} then copies[{i}] end), 0)").alias("n_pos"),
                 F.expr(f"coalesce(sum(case when not {of_class} then copies[{i}] end), 0)").alias("n_neg"))
        for i, (m, run) in enumerate(draws)
    ]
    return drawn.agg(F.array(*sums).alias("runs")).selectExpr("inline(runs)")


def repeated_runs(
    data: DataFrame, estimator: Estimator, multipliers: Sequence[float], majority_fraction: float, runs: int = 5,
    *, label_col: str = "label", minority_tag: int = 1, parallelism: int = 1, **options,
) -> DataFrame:
    """``multiplier, run, n_pos, n_neg, auc`` of ``runs`` fits for each multiplier of the minority class.

    The split is the same in every run unless ``split_seeds`` are given; resampling is not. Every draw is worked out once,
    with the copies of all runs beside each row; sizes come from one aggregate, and the test scores of all runs go into
    one exact AUC per run. Features are scaled only for an estimator that reads them scaled. Up to ``parallelism`` fits
    run at once, each with its own copy of ``estimator``; a fit does not depend on the others. Four at once took the
    driver of the check tool over its 1500 MB, so one at a time is the default.
    """
    draws, drawn = drawn_runs(data, multipliers, majority_fraction, runs, label_col=label_col, minority_tag=minority_tag, **options)
    drawn = drawn.persist(StorageLevel.MEMORY_AND_DISK)

    def scored_run(i, multiplier, run):
        def task():
            train, test = repeated(drawn, f"copies[{i}]"), drawn.where(f"copies[{i}] is null")
            if estimator.getFeaturesCol() == "scaledFeatures":
                scaler = fit_scaler(train)
                train, test = scaler.transform(train), scaler.transform(test)
            model = estimator.copy().fit(train)
            return churn_score(model.transform(test)).select(F.lit(multiplier).alias("multiplier"), F.lit(run).alias("run"), "score", label_col)
        return task

    try:
        sizes = staged(run_sizes(draws, drawn, label_col, minority_tag))
        tasks = [inheritable_thread_target(drawn.sparkSession)(scored_run(i, m, r)) for i, (m, r) in enumerate(draws)]
        with ThreadPool(processes=max(1, min(parallelism, len(tasks)))) as pool:
            scored = pool.map(lambda f: f(), tasks)
        auc = staged(area_under_roc(reduce(DataFrame.unionByName, scored), label=label_col, by=("multiplier", "run")))
    finally:
        drawn.unpersist()
    return sizes.join(auc, ["multiplier", "run"], "left").select("multiplier", "run", "n_pos", "n_neg", "auc")


@dataclass
class Search:
    """Outcome of a grid search: the cross-validated model, its test predictions and their curves."""

    model: CrossValidatorModel
    predictions: DataFrame
    roc: DataFrame
    pr: DataFrame


def tune(
    data: DataFrame,
    estimator: Estimator,
    grid: list,
    minority_multiplier: float,
    majority_fraction: float,
    folds: int = 2,
    *,
    label_col: str = "label",
    minority_tag: int = 1,
    key: str = "userId",
    split_seed: int = SPLIT_SEED,
    sample_seed: int = 0,
    fold_seed: int = 0,
    jitter: float = 0.01,
    one_fold_per_key: bool = False,
    parallelism: int = 4,
) -> Search:
    """Cross-validate ``grid`` on the resampled training part, then score the test part.

    By default drawn copies of one user may land in several folds, as in plain cross-validation;
    ``one_fold_per_key`` keeps the copies of a user in one fold.
    """
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = train_test(
            data, minority_multiplier, majority_fraction, label_col, minority_tag,
            key=key, split_seed=split_seed, sample_seed=sample_seed, jitter=jitter,
        )
        search = CrossValidator(
            estimator=estimator,
            estimatorParamMaps=grid,
            evaluator=BinaryClassificationEvaluator(labelCol=label_col, numBins=0),
            numFolds=folds,
            seed=fold_seed,
            parallelism=parallelism,
        )
        if one_fold_per_key:
            train = train.withColumn("fold", F.expr(f"int(floor({uniform_sql(key, 'fold', fold_seed)} * {folds}))"))
            search = search.setFoldCol("fold")
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = search.fit(train)
        finally:
            train.unpersist()
    finally:
        data.unpersist()
    predictions = model.transform(test)
    scored = churn_score(predictions)
    return Search(model, predictions, roc_curve(scored, label=label_col), pr_curve(scored, label=label_col))


def search_report(search: Search, names: list[str]) -> DataFrame:
    """``part, name, x, y``: everything a search is judged by, in one long table.

    ``metric`` has the parameters of a grid point and its mean metric (x is 1 for the best); ``roc`` and ``pr`` the curves of
    the best model on the test rows; ``importance`` the features of that model that take part in a split.
    """
    spark = search.predictions.sparkSession
    best = search.model.bestModel
    gained = importances_of(tree_nodes(spark, best, names), best.__class__.__name__.startswith("GBT"))
    none = F.lit(None).cast("string").alias("name")
    return (
        grid_report(spark, search.model).select(F.lit("metric").alias("part"), F.col("params").alias("name"), F.col("best").cast("double").alias("x"), F.col("avg_metric").alias("y"))
        .unionByName(search.roc.select(F.lit("roc").alias("part"), none, F.col("fpr").alias("x"), F.col("tpr").alias("y")))
        .unionByName(search.pr.select(F.lit("pr").alias("part"), none, F.col("recall").alias("x"), F.col("precision").alias("y")))
        .unionByName(gained.select(F.lit("importance").alias("part"), F.col("feature").alias("name"), F.lit(None).cast("double").alias("x"), F.col("score").alias("y")))
    )
