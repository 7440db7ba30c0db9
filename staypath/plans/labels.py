"""Churn label and the checks made on it."""

import datetime

from pyspark.sql import DataFrame, functions as F

from staypath.functions.columns import ratio, recency_flags_sql
from staypath.operators.activity import LATEST, activity, events_before_last
from staypath.schema import LABEL


def churn_label(log: DataFrame, max_days: int | None = None, as_of: datetime.date | str | None = None) -> DataFrame:
    """``last_status_cancelled``: 1 if the user's latest logged-in page is a cancel or a downgrade.

    ``max_days`` looks at the last days only. Equal times are decided by the item number.
    """
    latest = (
        activity(log, max_days=max_days, as_of=as_of)
        .where("userId is not null")
        .groupBy("userId")
        .agg(F.expr(f"{LATEST} as latest"))
    )
    return latest.select("userId", F.expr(f"{recency_flags_sql('latest')} % 2 as {LABEL}"))


def churn_rate(labels: DataFrame) -> DataFrame:
    """Churned users, all users and their ratio."""
    return labels.agg(
        F.expr(f"coalesce(sum({LABEL}), 0) as churned_users"),
        F.expr("count(*) as users"),
        ratio(f"sum({LABEL})", "count(*)", "churn_rate"),
    )


def label_checks(labels: DataFrame) -> DataFrame:
    """Rows and distinct users of the label table; equal if each user has one label."""
    per_user = labels.groupBy("userId").agg(F.count("*").alias("n"))
    return per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("label_rows"), F.count("*").alias("label_users")
    )


def post_cancel_events(log: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Cancel events with later activity of the same user; with ``columns`` only these activity columns are carried along."""
    events = activity(log)
    if columns is not None:
        needed = ("userId", "time", "itemInSession", "page", "level")
        events = events.select(*dict.fromkeys((*columns, *needed)))
    return events_before_last(events).select(*(columns or events.columns))
