"""Whether a fitted logistic regression is at the optimum of its loss."""

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, functions as F

INTERCEPT = "(intercept)"


def loss_gradient(model: LogisticRegressionModel, training: DataFrame, names: list[str], label: str = "label") -> DataFrame:
    """``feature, coefficient, gradient``: the slope of the mean log loss, with its L2 penalty, at the fitted coefficients.

    ``training`` holds the feature columns the model was fitted on, a row for each training row. As in the fit, a
    feature counts in units of its deviation, so slopes compare between features; all are close to zero at the optimum.
    A feature of one value has slope 0. One native aggregate over the rows.
    """
    if model.getElasticNetParam() and model.getRegParam():
        raise ValueError("the loss with an L1 penalty has no gradient at its optimum")
    weights = [float(w) for w in model.coefficients.toArray()]
    margin = " + ".join([f"double('{float(model.intercept)!r}')", *[f"double('{w!r}') * `{n}`" for n, w in zip(names, weights, strict=True)]])
    residual = training.withColumn("_r", F.expr(f"1 / (1 + exp(-({margin}))) - `{label}`"))
    sums = residual.agg(F.array(F.struct(F.lit(INTERCEPT).alias("feature"), F.lit(float(model.intercept)).alias("coefficient"),
                                         F.avg("_r").alias("slope"), F.lit(1.0).alias("unit")),
                                *[F.struct(F.lit(n).alias("feature"), F.lit(w).alias("coefficient"), F.expr(f"avg(_r * `{n}`)").alias("slope"),
                                           F.expr(f"double(stddev_samp(`{n}`))").alias("unit")) for n, w in zip(names, weights)]).alias("rows"))
    penalty = F.lit(float(model.getRegParam())) * F.col("coefficient") * (F.col("unit") if model.getStandardization() else 1 / F.col("unit"))
    penalty = F.when(F.col("feature") == INTERCEPT, 0.0).otherwise(penalty)
    gradient = F.when(F.col("unit") > 0, F.col("slope") / F.col("unit") + penalty).otherwise(0.0)
    return sums.selectExpr("inline(rows)").select("feature", "coefficient", gradient.alias("gradient"))
