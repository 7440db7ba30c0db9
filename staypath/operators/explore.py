"""Profile of the raw log and of wide tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from staypath.functions.columns import song_title


def dataset_summary(log: DataFrame) -> DataFrame:
    """Rows, rows without a user id, and distinct users (no id counts as one), in one pass."""
    per_user = log.groupBy("userId").agg(F.count("*").alias("n"))
    return per_user.agg(
        F.expr("coalesce(sum(n), 0) as n_rows"),
        F.expr("coalesce(sum(case when userId is null then n end), 0) as null_user_rows"),
        F.expr("count(*) as users"),
    )


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def top_songs(log: DataFrame, k: int = 10) -> DataFrame:
    """The k titles with most rows, over all rows with a song; equal counts go by title."""
    titles = log.where(F.col("song").isNotNull()).select(song_title().alias("singer_song"))
    return count_by(titles, "singer_song").orderBy(F.desc("n"), "singer_song").limit(k)


def preview(df: DataFrame, n: int = 10, keys: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` rows whose ``keys`` (all columns by default) have the smallest hashes; equal hashes go by all columns.

    Looks random, but is the same for any layout of the table: each task keeps its ``n`` smallest in a heap, and the heaps
    are merged. Nothing is sorted as a whole.
    """
    keys = df.columns if keys is None else keys
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])
    return df.orderBy(F.md5(text), *[f"`{c}`" for c in df.columns]).limit(n)


def max_days_back(events: DataFrame) -> DataFrame:
    """How many days of activity the log covers."""
    return events.agg(F.max("days_before_today").alias("max_days_before_today"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, one row."""
    columns = df.columns if columns is None else columns
    return df.agg(*[F.expr(f"count_if(`{c}` is null) as `{c}`") for c in columns])


def rows_with_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def events_of_user(log: DataFrame, user: str) -> DataFrame:
    """All events of one user; ids are text and are compared as text."""
    return log.where(F.col("userId") == str(user))


def column_means(df: DataFrame, columns: Sequence[str] | None = None, decimals: int = 2) -> DataFrame:
    """Rounded mean of each column but ``userId``, one row."""
    columns = [c for c in df.columns if c != "userId"] if columns is None else columns
    return df.agg(*[F.expr(f"round(avg(`{c}`), {decimals}) as `{c}`") for c in columns])


def means_by(df: DataFrame, key: str, columns: Sequence[str], decimals: int | None = None) -> DataFrame:
    """Mean of each column per value of ``key``."""
    form = "avg(`{c}`)" if decimals is None else "round(avg(`{c}`), {d})"
    return df.groupBy(key).agg(*[
        F.expr(form.format(c=c, d=decimals) + f" as `mean_{c}`") for c in columns
    ])
