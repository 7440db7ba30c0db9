"""Use time, page actions, membership and last action per user, from one pass over the activity.

The log is reduced to one row per (user, day, session) before anything else. Those rows are then
rolled up to sessions and to days side by side (grouping sets) and folded to users. Every level
groups by its full key, so a user with a huge share of the log is spread over tasks until only one
row per session and day is left, and those are combined map-side before the last shuffle.
"""

from pyspark.sql import DataFrame, functions as F

from staypath.functions.columns import ratio, recency_flags_sql
from staypath.operators.activity import IS_PAID, LATEST
from staypath.schema import COUNTED_PAGES, DAY_PART_SHARES, DAY_PARTS, SHARED_PAGES, USAGE_COLUMNS

# grouping_id of the two roll-ups below: a set bit marks a key that is rolled away
BY_SESSION, BY_DAY = 1, 2


def _columns(*texts: str) -> list:
    return [F.expr(text) for text in texts]


def session_days(events: DataFrame) -> DataFrame:
    """One row per (user, day, session): counts, first/last time overall and per day part, flags."""
    parts = [
        f"{side}(case when time_in_the_day = '{name}' then time end) as {side}_{share}"
        for share, name in zip(DAY_PART_SHARES, DAY_PARTS) for side in ("min", "max")
    ]
    pages = [f"count_if(page = '{page}') as n_{key}" for key, page in COUNTED_PAGES.items()]
    return events.where("userId is not null").groupBy("userId", "event_date", "sessionId").agg(*_columns(
        "count(*) as n",
        "min(time) as first_time",
        "max(time) as last_time",
        *parts,
        f"max(int({IS_PAID})) as any_paid",
        f"max(int(not {IS_PAID})) as any_free",
        *pages,
        f"{LATEST} as latest",
    ))


def sessions_and_days(rows: DataFrame) -> DataFrame:
    """Session rows and day rows of every user, told apart by ``kind``."""
    user, session, day = F.col("userId"), F.col("sessionId"), F.col("event_date")
    return rows.groupingSets([[user, session], [user, day]], user, session, day).agg(*_columns(
        "grouping_id() as kind",
        "sum(n) as n",
        "max(last_time) - min(first_time) as span",
        *[f"max(max_{s}) - min(min_{s}) as span_{s}" for s in DAY_PART_SHARES],
        "count(*) as pieces",
        "sum(last_time - first_time) as piece_time",
        "max(any_paid) as any_paid",
        "max(any_free) as any_free",
        *[f"sum(n_{key}) as n_{key}" for key in COUNTED_PAGES],
        "max(latest) as latest",
    ))


def usage_features(events: DataFrame) -> DataFrame:
    """Use-time, action and membership columns, plus ``last_status_cancelled``, per user of the events."""
    return usage_of(session_days(events))


def usage_of(rows: DataFrame) -> DataFrame:
    """The same from :func:`session_days` rows; a session over midnight has a row for each day and is put together here.

    A caller that selects some of the columns pays only for those.
    """
    def of_session(column):
        return f"case when kind = {BY_SESSION} then {column} end"

    def of_day(column):
        return f"case when kind = {BY_DAY} then {column} end"

    totals = sessions_and_days(rows).groupBy("userId").agg(*_columns(
        f"count_if(kind = {BY_SESSION}) as sessions",
        f"sum({of_session('n')}) as items",
        f"count_if(kind = {BY_DAY}) as active_days",
        f"sum({of_session('span')}) as active_time",
        f"avg({of_day('pieces')}) as sessions_per_day",
        f"avg({of_day('piece_time')}) as time_per_day",
        f"avg({of_session('n')}) as avg_items_per_session",
        f"avg({of_session('span')}) as time_per_session",
        *[f"coalesce(sum({of_session(f'span_{s}')}), 0) as span_{s}" for s in DAY_PART_SHARES],
        *[f"sum({of_session(f'n_{key}')}) as numbers_{key}" for key in COUNTED_PAGES],
        f"sum({of_day('any_paid')}) as paid_days",
        f"sum({of_day('any_free')}) as free_days",
        "max(latest) as latest",
    ))
    all_parts = " + ".join(f"span_{s}" for s in DAY_PART_SHARES)
    flags = recency_flags_sql("latest")
    return totals.select(
        "userId",
        *USAGE_COLUMNS,
        *[ratio(f"span_{s}", all_parts, s) for s in DAY_PART_SHARES],
        *[f"numbers_{key}" for key in COUNTED_PAGES],
        *[ratio(f"numbers_{key}", "items", f"perc_{key}") for key in SHARED_PAGES],
        F.expr(f"int({flags} >= 2) as last_status_paid"),
        "paid_days",
        # a day with paid and free events stands for two day/status pairs
        ratio("paid_days", "paid_days + free_days", "perc_paid_days"),
        F.expr(f"{flags} % 2 as last_status_cancelled"),
    )
