"""Resampling and splitting decided per row by a hash of its key.

A draw depends on the key, a purpose and a seed only: not on partitioning, row order or a recomputed task, so
a training set stays the same when an executor is lost or the cluster size changes.
"""

import math

from pyspark.sql import DataFrame, functions as F


def uniform_sql(key: str, purpose: str, seed: int) -> str:
    """Draw in [0, 1) from 52 bits of a hash of ``key``, ``purpose`` and ``seed``.

    The purposes are ``split``, ``sample`` and ``fold``: equal seeds give them unrelated draws. A null key
    draws like an empty text, so its rows stay together and none is lost.
    """
    text = f"concat(coalesce(string({key}), ''), ':{purpose}:{seed}')"
    return f"(double(conv(substring(md5({text}), 1, 13), 16, 10)) / double({2**52}))"


def poisson_steps(rate: float) -> list[float]:
    """Cumulative Poisson probabilities up to the last one a 52-bit draw can tell from 1."""
    steps, term, total, k = [], math.exp(-rate), 0.0, 0
    while True:
        total += term
        if total >= 1 - 2**-53 or (k > rate and term < 2**-60):
            return steps
        steps.append(total)
        k += 1
        term *= rate / k


def copies_with_replacement(draw: str, rate: float) -> str:
    """How often a row is drawn when sampling with replacement at ``rate`` (Poisson)."""
    return " + ".join(f"int({draw} >= double('{step!r}'))" for step in poisson_steps(rate))


def copies_without_replacement(draw: str, fraction: float) -> str:
    return f"int({draw} < double('{fraction!r}'))"


def copies_sql(
    minority_multiplier: float, majority_fraction: float, label_col: str = "label", minority_tag: int = 1,
    *, key: str = "userId", seed: int = 0, jitter: float = 0.01,
) -> str:
    """How often :func:`resample` takes a row; null for a row without label."""
    def untouched(rate):
        return jitter == 0 and rate == 1

    draw = uniform_sql(key, "sample", seed)
    minority = "1" if untouched(minority_multiplier) else copies_with_replacement("u", minority_multiplier + jitter)
    majority = "1" if untouched(majority_fraction) else copies_without_replacement("u", majority_fraction - jitter)
    # the draw gets a name, so that it is hashed once and not for every step
    return (
        f"get(transform(array({draw}), u -> case when {label_col} = {minority_tag} then {minority} "
        f"when {label_col} <> {minority_tag} then {majority} end), 0)"
    )


def resample(
    df: DataFrame,
    minority_multiplier: float,
    majority_fraction: float,
    label_col: str = "label",
    minority_tag: int = 1,
    *,
    key: str = "userId",
    seed: int = 0,
    jitter: float = 0.01,
) -> DataFrame:
    """Draw the minority class with and the majority class without replacement.

    The rates are ``minority_multiplier + jitter`` and ``majority_fraction - jitter``. With
    ``jitter=0`` a multiplier or fraction of 1 leaves its class as it is.
    """
    copies = copies_sql(minority_multiplier, majority_fraction, label_col, minority_tag, key=key, seed=seed, jitter=jitter)
    return repeated(df.withColumn("_copies", F.expr(copies)), "_copies").drop("_copies")


def repeated(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as the expression ``copies`` says."""
    return df.where(f"{copies} > 0").withColumn("_copy", F.expr(f"explode(sequence(1, {copies}))")).drop("_copy")


def in_train_sql(train_share: float = 0.7, *, key: str = "userId", seed: int = 100) -> str:
    return f"{uniform_sql(key, 'split', seed)} < double('{train_share!r}')"


def split(df: DataFrame, train_share: float = 0.7, *, key: str = "userId", seed: int = 100):
    """Train and test rows; the draw is the same rule in every class, so each is split alike."""
    in_train = in_train_sql(train_share, key=key, seed=seed)
    return df.where(in_train), df.where(f"not ({in_train})")
