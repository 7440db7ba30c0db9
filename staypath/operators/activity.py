"""First-level cleaned log: logged-in events with day, day part, song title and age columns."""

import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from staypath.functions.columns import FIRST_MILLIS, LAST_MILLIS, day_part, days_until, event_day, latest_sql, recency_sql, song_title
from staypath.schema import CANCEL_PAGE, CHURN_PAGES, LOGGED_IN, PAID, PLAY_PAGE

# a played song with a known title; a paid event; an event that counts as churn if it is the last
IS_PLAY = f"singer_song is not null and page = '{PLAY_PAGE}'"
IS_PAID = f"coalesce(level = '{PAID}', false)"
IS_CHURN = "coalesce(page in ({}), false)".format(", ".join(f"'{page}'" for page in CHURN_PAGES))

# recency of an activity row carrying its paid (2) and churn-page (1) flags, and its maximum
FLAGS = f"(int({IS_PAID}) * 2 + int({IS_CHURN}))"
RECENCY = recency_sql("time", "itemInSession", FLAGS)
LATEST = latest_sql("time", "itemInSession", FLAGS)


def logged_in(log: DataFrame) -> DataFrame:
    return log.where(f"auth = '{LOGGED_IN}'")


def newest_day(log: DataFrame, as_of: datetime.date | str | None = None) -> Column:
    """The log's "today": day of its newest logged-in event, or ``as_of`` if given.

    Left as a scalar subquery, so nothing runs until the caller's own query does.
    """
    if as_of is not None:
        return F.lit(as_of).cast("date")
    return logged_in(log).where(f"ts <= {LAST_MILLIS}").agg(event_day("max(ts)")).scalar()


def windowed_as_of(log: DataFrame, max_days: int | None, min_days: int | None, as_of: datetime.date | str | None):
    """``as_of``, or for a window without one the log's newest day, fetched by one small job.

    With the day known, all bounds are constants that reach the scan; as nested subqueries each branch of
    a plan would hold copies of the whole log plan.
    """
    if as_of is not None or (max_days is None and min_days is None):
        return as_of
    return logged_in(log).where(f"ts <= {LAST_MILLIS}").agg(event_day("max(ts)").alias("day")).first()["day"]


def in_window(
    log: DataFrame,
    max_days: int | None = None,
    min_days: int | None = None,
    as_of: datetime.date | str | None = None,
) -> DataFrame:
    """Rows at least ``min_days`` and at most ``max_days`` before the newest day or ``as_of``, both inclusive.

    Rows after ``as_of`` are left out, so a past day does not see what came later; so are rows without a valid
    time once a bound or day is given. Compares the raw ``ts`` with the first moment of a day, so that the scan can
    skip row groups.
    """
    as_of = windowed_as_of(log, max_days, min_days, as_of)
    if as_of is None:
        return log if max_days is None and min_days is None else log.limit(0)

    def day_start(days_back: int) -> Column:
        return F.expr(f"unix_millis(timestamp(date_sub(date'{as_of}', {days_back})))")

    log = log.where(F.col("ts") >= (F.lit(FIRST_MILLIS) if max_days is None else day_start(max_days)))
    return log.where(F.col("ts") < day_start(-1 if min_days is None else min_days - 1))


def activity(
    log: DataFrame,
    max_days: int | None = None,
    min_days: int | None = None,
    as_of: datetime.date | str | None = None,
) -> DataFrame:
    """Logged-in events of the window with their derived columns."""
    as_of = windowed_as_of(log, max_days, min_days, as_of)
    rows = logged_in(in_window(log, max_days, min_days, as_of)).select(
        "userId",
        "registration",
        event_day("registration").alias("registration_date"),
        "level",
        F.expr("ts as time"),
        event_day("ts").alias("event_date"),
        day_part("ts").alias("time_in_the_day"),
        "sessionId",
        "itemInSession",
        "page",
        "artist",
        song_title().alias("singer_song"),
        "length",
    )
    return rows.withColumns({
        "days_since_registration": days_until("event_date", "registration_date"),
        "days_before_today": days_until(newest_day(log, as_of), "event_date"),
    })


def events_before_last(events: DataFrame, page: str = CANCEL_PAGE) -> DataFrame:
    """Activity rows on ``page`` that are not their user's latest row.

    Of the rows that tie for latest exactly one counts as the latest. Rows meet the latest one of their user by (user,
    recency), so a user with very many rows is spread over all tasks. Rows that differ from it pass straight; only those
    that tie with it are folded to counts, numbered and spread out again. Both joins read the same two shuffles, of the
    columns of ``events``: select those that are wanted first.
    """
    events = events.where("userId is not null")
    columns = events.columns
    latest = events.groupBy("userId").agg(F.expr(f"{LATEST} as recency"))
    found = events.where(F.col("page") == page).withColumn("recency", F.expr(RECENCY))
    tied = found.join(latest, ["userId", "recency"], "left_semi").groupBy("recency", *columns).agg(F.expr("count(*) as copies"))
    ties = Window.partitionBy("userId", "recency").orderBy(*columns)
    left = tied.withColumn("copies", F.col("copies") - (F.row_number().over(ties) == 1).cast("int"))
    return found.join(latest, ["userId", "recency"], "left_anti").select(*columns).unionByName(
        repeat_rows(left.where("copies > 0"), "copies").select(*columns))


def repeat_rows(df: DataFrame, copies: str, chunk: int = 10_000) -> DataFrame:
    """Each row ``copies`` times (``copies`` >= 1); counts above ``chunk`` are spread over tasks."""
    chunks = df.withColumn("_part", F.expr(f"explode(sequence(0, ({copies} - 1) div {chunk}))"))
    size = f"least({chunk}, {copies} - _part * {chunk})"
    return (
        chunks.repartition(*df.columns, "_part")
        .withColumn("_copy", F.expr(f"explode(sequence(1, {size}))"))
        .drop("_part", "_copy")
    )
