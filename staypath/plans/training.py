"""Training set: features with nulls filled, joined with the label."""

import datetime

from pyspark.sql import DataFrame, functions as F

from staypath.operators.activity import windowed_as_of
from staypath.plans.features import feature_table
from staypath.plans.labels import churn_label
from staypath.schema import LABEL


def training_set(
    log: DataFrame,
    excluded_users: tuple[str, ...] = (),
    *,
    feature_max_days: int | None = None,
    feature_min_days: int | None = None,
    label_max_days: int | None = None,
    as_of: datetime.date | str | None = None,
    **feature_options,
) -> DataFrame:
    """Feature rows of labelled users, numeric nulls as 0, label last.

    By default features and label both use the whole log, and the label rides along with the usage
    roll-up. With ``feature_min_days`` or ``label_max_days`` a gap can be kept between the days that
    features see and the days that decide the label; the label then comes from its own pass.
    """
    windowed = not (feature_max_days is None and feature_min_days is None and label_max_days is None)
    newest = as_of
    if windowed and as_of is None:  # one job finds the day for both windows
        newest = windowed_as_of(log, 0, 0, None)
    features = feature_table(
        log, feature_max_days, feature_min_days, as_of=as_of, newest=newest, label=not windowed, **feature_options
    )
    if excluded_users:
        features = features.where(~F.col("userId").isin(list(excluded_users)))
    if windowed:
        return features.fillna(0).join(churn_label(log, label_max_days, newest if label_max_days is not None else as_of), "userId")
    return features.where(F.col(LABEL).isNotNull()).fillna(0)
