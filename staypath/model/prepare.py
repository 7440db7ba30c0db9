"""From training set to scaled train and test tables."""

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from staypath.model.sampling import resample, split
from staypath.schema import LABEL

# Fixed value: seed of the train/test split.
SPLIT_SEED = 100


def feature_names(training: DataFrame, label: str = LABEL, key: str = "userId") -> list[str]:
    return [c for c in training.columns if c not in (label, key)]


def assemble(
    training: DataFrame, label: str = LABEL, key: str = "userId", columns: Sequence[str] | None = None
) -> DataFrame:
    """``userId, features, label``; nulls must have been filled."""
    columns = feature_names(training, label, key) if columns is None else list(columns)
    data = VectorAssembler(inputCols=columns, outputCol="features").transform(training)
    return data.select(F.col(key), "features", F.col(label).alias("label"))


def fit_scaler(training: DataFrame) -> StandardScalerModel:
    """Scaling by standard deviation, without centring."""
    scaler = StandardScaler(inputCol="features", outputCol="scaledFeatures", withStd=True, withMean=False)
    return scaler.fit(training)


def train_test(
    data: DataFrame,
    minority_multiplier: float,
    majority_fraction: float,
    label_col: str = "label",
    minority_tag: int = 1,
    train_share: float = 0.7,
    *,
    key: str = "userId",
    split_seed: int = SPLIT_SEED,
    sample_seed: int = 0,
    jitter: float = 0.01,
) -> tuple[DataFrame, DataFrame]:
    """Split, resample the training part only, scale both parts by the training part's deviation."""
    train, test = split(data, train_share, key=key, seed=split_seed)
    train = resample(
        train, minority_multiplier, majority_fraction, label_col, minority_tag,
        key=key, seed=sample_seed, jitter=jitter,
    )
    scaler = fit_scaler(train)
    return scaler.transform(train), scaler.transform(test)
