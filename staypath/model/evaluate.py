"""ROC and precision/recall tables, area under ROC, importances and grid reports."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from staypath.functions.columns import ratio
from staypath.sources.tables import staged


def churn_score(predictions: DataFrame) -> DataFrame:
    """Predictions with the probability of class 1 as ``score``."""
    return predictions.withColumn("score", vector_to_array("probability")[1])


def score_totals(scored: DataFrame, score: str = "score", label: str = "label", by: tuple[str, ...] = ()) -> DataFrame:
    """Per distinct score, from the highest down: its positives and negatives, and those so far and in all.

    Exact for any scores. Rows are first counted per score; the counts are stored, as cuts, offsets and totals all read
    them. The scores are cut into ranges at approximate quantiles. Running totals inside a range start from the totals of
    the ranges above it, so no task orders more than a range, wherever the cuts fall. Rows without score are left out.
    ``by`` names columns, such as a run, whose values have curves of their own.
    """
    ranges = max(2, int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = staged(scored.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = counts.agg(F.percentile_approx("threshold", shares, F.lit(10 * ranges))).scalar()
    below = F.expr("size(filter(cuts, cut -> cut <= threshold))")
    ranged = counts.withColumn("cuts", cuts).withColumn("part", below).drop("cuts")
    down = Window.partitionBy(*by).orderBy(F.desc("part"))
    above, every = down.rowsBetween(Window.unboundedPreceding, -1), down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one row per range and curve, so ordering them and sending them everywhere is bounded by the number of ranges
    offsets = ranged.groupBy(*by, "part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).select(
        *by, "part",
        F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("pos_above"), F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("neg_above"),
        F.sum("pos").over(every).alias("all_pos"), F.sum("neg").over(every).alias("all_neg"))
    inside = Window.partitionBy(*by, "part").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(F.broadcast(offsets), [*by, "part"]).select(
        *by, "threshold", "pos", "neg",
        (F.col("pos_above") + F.sum("pos").over(inside)).alias("tp"), (F.col("neg_above") + F.sum("neg").over(inside)).alias("fp"),
        "all_pos", "all_neg")


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``threshold, fpr, tpr`` per distinct score; the start (0, 0) is not listed."""
    return score_totals(scored, score, label).select(
        "threshold", ratio("fp", "all_neg", "fpr"), ratio("tp", "all_pos", "tpr"))


def pr_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``threshold, recall, precision`` per distinct score."""
    return score_totals(scored, score, label).select(
        "threshold", ratio("tp", "all_pos", "recall"), ratio("tp", "tp + fp", "precision"))


def area_under_roc(scored: DataFrame, score: str = "score", label: str = "label", by: tuple[str, ...] = ()) -> DataFrame:
    """One row ``auc``, or one for each value of ``by``: trapezoids under :func:`roc_curve`, added up in whole numbers."""
    doubled = "sum(cast(neg as decimal(19, 0)) * (cast(tp as decimal(19, 0)) * 2 - pos))"
    auc = ratio(doubled, "double(max(all_pos)) * double(max(all_neg)) * 2", "auc")
    return score_totals(scored, score, label, by).groupBy(*by).agg(auc)


def importance_table(spark: SparkSession, model, names: list[str]) -> DataFrame:
    """``feature, score`` of a fitted model: tree importances, or coefficients of a linear model."""
    weights = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    rows = [(name, float(weight)) for name, weight in zip(names, weights.toArray(), strict=True)]
    return spark.createDataFrame(rows, "feature string, score double")


def top_features(importances: DataFrame, k: int = 10) -> DataFrame:
    return importances.orderBy(F.desc("score"), "feature").limit(k)


def grid_report(spark: SparkSession, cv_model) -> DataFrame:
    """One row per grid point: parameters as text, mean metric over folds, whether it won."""
    metrics = cv_model.avgMetrics
    better = max if cv_model.getEvaluator().isLargerBetter() else min
    best = metrics.index(better(metrics))
    rows = [
        (", ".join(f"{param.name}={value}" for param, value in sorted(point.items(), key=lambda i: i[0].name)),
         float(metric), number == best)
        for number, (point, metric) in enumerate(zip(cv_model.getEstimatorParamMaps(), metrics, strict=True))
    ]
    return spark.createDataFrame(rows, "params string, avg_metric double, best boolean")
