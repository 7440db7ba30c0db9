"""One-hot encoding: a long categorical column becomes one count column per value."""

import re

from pyspark.sql import DataFrame, functions as F


#: values that may become columns when no list is given
MAX_COLUMNS = 1000


def vocabulary(df: DataFrame, column: str, max_values: int = MAX_COLUMNS) -> list[str]:
    """Sorted distinct non-null values of ``column``; they become column names, so at most ``max_values`` reach the driver.

    More values are an error, not cut off: ``dictionary.sparse_rows`` has no such limit, a given list is wide at any
    length, and ``other`` counts what a list leaves out.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct().limit(max_values + 1).collect()
    if len(values) > max_values:
        raise ValueError(f"{column} has more than {max_values} values; use a dictionary and sparse rows, or name the values")
    return sorted(row[0] for row in values)


def encoded_names(column: str, values: list[str]) -> dict[str, str]:
    """Column name per value: ``column_value`` with odd characters as ``_``, numbered if two collide."""
    names, taken = {}, set()
    for value in values:
        base = re.sub(r"[^A-Za-z0-9_]", "_", f"{column}_{value}")
        name, number = base, 2
        while name.lower() in taken:
            name, number = f"{base}_{number}", number + 1
        taken.add(name.lower())
        names[value] = name
    return names


def one_hot(df: DataFrame, column: str, values: list[str] | None = None, other: bool = False) -> DataFrame:
    """Group by every other column and count the rows of each value.

    Counts are 0/1 if ``df`` has no duplicate rows. ``values`` fixes the output schema; without it
    the vocabulary is fitted by one extra job. ``other`` adds ``<column>_other``, the rows whose value is
    not among ``values``.
    """
    if values is None:
        values = vocabulary(df, column)
    names = encoded_names(column, values)
    keys = [c for c in df.columns if c != column]
    if other:
        fallback = "other"
        while fallback in names:
            fallback += "_"
        df = df.withColumn(column, F.when(F.col(column).isin(list(values)) | F.col(column).isNull(), F.col(column)).otherwise(fallback))
        values = [*values, fallback]
        names = names | {fallback: f"{column}_other"}
    wide = df.groupBy(*keys).pivot(column, list(values)).agg(F.count(F.lit(1))) if values else df.select(*keys).distinct()
    counts = [F.coalesce(F.col(f"`{v}`"), F.lit(0).cast("bigint")).alias(names[v]) for v in values]
    return wide.select(*keys, *counts)
