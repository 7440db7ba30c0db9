"""The feature table: one row per user."""

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from staypath.functions.columns import ratio
from staypath.operators.activity import activity, in_window, newest_day, windowed_as_of
from staypath.plans.content import content_of, folded_song_plays, plays_fold, popular_share_of
from staypath.plans.profile import profile_fold, static_of, wanted_sources
from staypath.plans.usage import session_days, usage_of
from staypath.schema import (
    ACTION_COLUMNS, CONTENT_COLUMNS, DAY_PART_SHARES, LABEL, MEMBERSHIP_COLUMNS, USAGE_COLUMNS,
)


@dataclass(frozen=True)
class Folds:
    """What the features of a window are combined from, made from the log or read from a stored state."""

    sessions: DataFrame  #: per (user, day, session), see ``usage.session_days``
    plays: DataFrame  #: per (user, artist, song), see ``content.plays_fold``
    profile: DataFrame  #: per (user, agent text, location), see ``profile.profile_fold``
    today: Column  #: the day that ages are counted to


def folds_of_log(
    log: DataFrame,
    max_days: int | None = None,
    min_days: int | None = None,
    as_of: datetime.date | str | None = None,
    profile_log: DataFrame | None = None,
    length_decimals: int | None = None,
    sources=("userAgent", "location"),
    newest: datetime.date | str | None = None,
) -> Folds:
    """``newest`` hands down the log's newest day where the caller knows it; no job fetches it again."""
    newest = newest or windowed_as_of(log, max_days, min_days, as_of)
    windowed = (max_days, min_days) != (None, None)
    events = activity(log, max_days, min_days, newest if windowed else as_of)
    people = in_window(log if profile_log is None else profile_log, as_of=as_of)
    return Folds(session_days(events), plays_fold(events, length_decimals), profile_fold(people, sources), newest_day(log, newest))


def dynamic_of(
    folds: Folds, max_artist_perc: bool = False, label: bool = False, relative_error: float | None = None
) -> DataFrame:
    """Behaviour columns of every logged-in user of the window.

    Usage and content cover the same users, so they serve as the spine; the parts come out of
    their last aggregation already partitioned by user and join without another shuffle.
    """
    joined = (
        usage_of(folds.sessions)
        .join(content_of(folds.plays), "userId", "left")
        .join(popular_share_of(folded_song_plays(folds.plays), relative_error), "userId", "left")
    )
    return joined.select(
        "userId",
        *USAGE_COLUMNS,
        *DAY_PART_SHARES,
        *CONTENT_COLUMNS,
        *(["max_artist_perc"] if max_artist_perc else []),
        *ACTION_COLUMNS,
        "perc_popular_songs",
        *MEMBERSHIP_COLUMNS,
        *([LABEL] if label else []),
    )


def dynamic_features(
    log: DataFrame,
    max_days: int | None = None,
    min_days: int | None = None,
    as_of: datetime.date | str | None = None,
    length_decimals: int | None = None,
    max_artist_perc: bool = False,
    label: bool = False,
    relative_error: float | None = None,
) -> DataFrame:
    """Behaviour columns of every logged-in user of the window of a log."""
    folds = folds_of_log(log, max_days, min_days, as_of, length_decimals=length_decimals)
    return dynamic_of(folds, max_artist_perc, label, relative_error)


def features_of(
    folds: Folds,
    *,
    agents: list[str] | None = None,
    states: list[str] | bool = False,
    max_artist_perc: bool = False,
    active_day_share: bool = False,
    label: bool = False,
    relative_error: float | None = None,
) -> DataFrame:
    """Static and behaviour columns of every user; behaviour is null for users without events in the window."""
    static = static_of(folds.profile, folds.today, agents, states)
    table = static.join(dynamic_of(folds, max_artist_perc, label, relative_error), "userId", "outer")
    if active_day_share:
        table = table.select("*", ratio("active_days", "customer_age", "active_day_share"))
    return table


def feature_table(
    log: DataFrame,
    max_days: int | None = None,
    min_days: int | None = None,
    *,
    profile_log: DataFrame | None = None,
    states: list[str] | bool = False,
    as_of: datetime.date | str | None = None,
    length_decimals: int | None = None,
    newest: datetime.date | str | None = None,
    **options,
) -> DataFrame:
    """Static and behaviour columns of every user; behaviour is null for users never logged in.

    ``profile_log`` names the table with gender, registration, agent and location if the log
    keeps them elsewhere. ``label`` carries the churn label along at no extra pass; see :func:`features_of` for the
    other options.
    """
    folds = folds_of_log(log, max_days, min_days, as_of, profile_log, length_decimals, wanted_sources(states), newest)
    return features_of(folds, states=states, **options)
