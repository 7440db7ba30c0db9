"""Static features: gender, customer age, device (and, on request, state) per user."""

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from staypath.functions.columns import agent_tokens, days_until, event_day, state_codes
from staypath.operators.activity import in_window, newest_day
from staypath.operators.encode import encoded_names, one_hot, vocabulary
from staypath.schema import FEMALE

# per source column: prefix of the indicator columns and the function that lists a row's values
LISTS = {"userAgent": ("agent", agent_tokens), "location": ("state", state_codes)}


def listed_values(log: DataFrame, source: str) -> DataFrame:
    """Distinct (userId, value) of a list-like log column.

    Distinct source texts come first, so each text is taken apart once per user, not once per event.
    """
    name, parse = LISTS[source]
    texts = log.where("userId is not null").select("userId", source).distinct()
    return texts.select("userId", F.explode(parse(source)).alias(name)).distinct()


def list_vocabulary(log: DataFrame, source: str) -> list[str]:
    """Values of ``source`` anywhere in the log; one job over its distinct texts."""
    name, parse = LISTS[source]
    texts = log.where("userId is not null").select(source).distinct()
    return vocabulary(texts.select(F.explode(parse(source)).alias(name)), name)


def list_one_hot(log: DataFrame, source: str, values: list[str] | None = None, other: bool = False) -> DataFrame:
    """0/1 column per value of ``source``; users without any value are absent. ``other`` counts unlisted values."""
    return one_hot(listed_values(log, source), LISTS[source][0], values, other)


def profile_fold(log: DataFrame, sources=tuple(LISTS), *keys: str) -> DataFrame:
    """One row per (user, texts of ``sources``) and any other ``keys``: ever logged as female, first registration."""
    return log.where("userId is not null").groupBy("userId", *keys, *sources).agg(
        F.expr(f"max(int(coalesce(gender = '{FEMALE}', false))) as female"),
        F.expr("min(registration) as registration"),
    )


def merged_profile(fold: DataFrame) -> DataFrame:
    """One row per (user, agent text, location) from folds of several days."""
    return fold.groupBy("userId", *LISTS).agg(F.expr("max(female) as female"), F.expr("min(registration) as registration"))


def static_features(
    log: DataFrame,
    agents: list[str] | None = None,
    states: list[str] | bool = False,
    as_of: datetime.date | str | None = None,
    activity_log: DataFrame | None = None,
) -> DataFrame:
    """``female``, ``customer_age`` and ``agent_*`` for every user of the log, logged in or not.

    Users with no agent at all keep nulls in ``agent_*``. A user with several registrations
    counts from the first; one who was ever logged as female is female. ``states`` adds ``state_*``
    columns (a list fixes them, ``True`` fits them).
    ``activity_log`` gives the newest day if it should come from another table than ``log``. With ``as_of``
    events after that day are left out, and so are users who have no others.
    """
    log = in_window(log, as_of=as_of)
    today = newest_day(log if activity_log is None else activity_log, as_of)
    return static_of(profile_fold(log, wanted_sources(states)), today, agents, states)


def wanted_sources(states: list[str] | bool) -> list[str]:
    return ["userAgent"] if states is False else list(LISTS)


def static_of(
    folded: DataFrame, today: Column, agents: list[str] | None = None, states: list[str] | bool = False
) -> DataFrame:
    """:func:`static_features` from :func:`profile_fold` rows; each text is parsed once per user."""
    wanted = {"userAgent": list_vocabulary(folded, "userAgent") if agents is None else agents}
    if states is not False:
        wanted["location"] = list_vocabulary(folded, "location") if states is True else states
    indicators = []
    for source, values in wanted.items():
        name, parse = LISTS[source]
        folded = folded.withColumn(f"{name}_list", parse(source))
        for value, column in encoded_names(name, values).items():
            quoted = value.replace("\\", "\\\\").replace("'", "\\'")
            found = f"bigint(array_contains({name}_list, '{quoted}'))"
            indicators.append(F.expr(f"max(case when size({name}_list) > 0 then {found} end) as {column}"))
    people = folded.groupBy("userId").agg(
        F.expr("max(female) as female"), F.expr("min(registration) as registration"), *indicators
    )
    age = days_until(today, event_day("registration")).alias("customer_age")
    return people.select("userId", "female", age, *people.columns[3:])
