"""Stored daily state: folds of the log by day, from which the features of any window are combined.

Four Parquet tables, partitioned by day: ``sessions`` (user, day, session), ``plays`` (user, day, artist, song),
``profile`` (user, day, agent text, location) and ``days`` (events of a day). Every number in them is a sum, a minimum or a
maximum, so days merge in any order: a session over midnight has a row for each of its days and is one session again
when they are combined. A day's rows depend on that day's events only. So a new day is added, and a day with late events made
anew, by reading that day of the log and replacing that day's partitions; a task or job that runs again writes the same
rows. A window reads the partitions of its days and nothing of the log.
"""

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from staypath.functions.columns import event_day
from staypath.operators.activity import activity
from staypath.plans.content import merged_plays, plays_fold
from staypath.plans.features import Folds, features_of
from staypath.plans.profile import merged_profile, profile_fold
from staypath.plans.usage import session_days
from staypath.schema import EVENT_SCHEMA, LOGGED_IN

Day = datetime.date | str
DAY = "event_date"


def daily_folds(log: DataFrame, length_decimals: int | None = None, profile_log: DataFrame | None = None) -> dict[str, DataFrame]:
    """The state's tables by name, each one row per key and day."""
    events = activity(log)
    people = (log if profile_log is None else profile_log).withColumn(DAY, event_day("ts"))
    return {
        "sessions": session_days(events),
        "plays": plays_fold(events, length_decimals, DAY),
        "profile": profile_fold(people, ("userAgent", "location"), DAY),
        "days": log.groupBy(event_day("ts").alias(DAY)).agg(
            F.expr("count(*) as events"), F.expr(f"count_if(auth = '{LOGGED_IN}') as logged_in")),
    }


def write_state(
    log: DataFrame,
    path: str,
    *,
    first_day: Day | None = None,
    last_day: Day | None = None,
    length_decimals: int | None = None,
    profile_log: DataFrame | None = None,
) -> None:
    """Write the state of a log, or replace the days from ``first_day`` to ``last_day`` in a state that is there.

    ``length_decimals`` and the session time zone must be the same for all days of a state; they are kept with it and checked.
    Rows without a valid time make a partition of their own, which is rewritten with the whole state only. A day that has
    lost all of its events keeps its old partitions. Few files are written per day: rows are rebalanced by day, and AQE
    cuts large days and joins small ones.
    """
    spark = log.sparkSession
    some = not (first_day is None and last_day is None)
    if some:
        held = settings(spark, path)
        if held != (spark.conf.get("spark.sql.session.timeZone"), length_decimals):
            raise ValueError(f"the state was written with time zone and decimals {held}")
        log, profile_log = (between(x, first_day, last_day) for x in (log, log if profile_log is None else profile_log))
    for name, table in daily_folds(log, length_decimals, profile_log).items():
        out = table.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY)
        out.option("partitionOverwriteMode", "dynamic" if some else "static").parquet(f"{path}/{name}")
    if not some:
        meta = spark.range(1).select(
            F.lit(spark.conf.get("spark.sql.session.timeZone")).alias("time_zone"), F.lit(length_decimals).cast("int").alias("length_decimals"))
        meta.write.mode("overwrite").parquet(f"{path}/settings")


def settings(spark: SparkSession, path: str) -> tuple[str, int | None]:
    """Time zone and length decimals of a state."""
    return tuple(spark.read.schema("time_zone string, length_decimals int").parquet(f"{path}/settings").first())


def between(log: DataFrame, first_day: Day | None, last_day: Day | None) -> DataFrame:
    """Rows of some days, by bounds on the raw ``ts`` that the scan can use."""
    def start(day: Day, days: int = 0) -> Column:
        return F.expr(f"unix_millis(timestamp(date_add(date'{day}', {days})))")

    if first_day is not None:
        log = log.where(F.col("ts") >= start(first_day))
    return log if last_day is None else log.where(F.col("ts") < start(last_day, 1))


class DailyState:
    """A stored state; its tables, and folds and features of a window of its days."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        zone, self.length_decimals = settings(spark, path)
        if zone != spark.conf.get("spark.sql.session.timeZone"):
            raise ValueError(f"the state's days are those of time zone {zone}")
        # known without looking at files, so an empty state has typed columns too
        empty = spark.createDataFrame([], EVENT_SCHEMA)
        self._schemas = {name: table.schema for name, table in daily_folds(empty, self.length_decimals).items()}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._schemas[name]).parquet(f"{self.path}/{name}")

    def newest_day(self) -> datetime.date | None:
        """Day of the newest logged-in event; reads the table of days only."""
        return self.table("days").where("logged_in > 0").agg(F.max(DAY)).first()[0]

    def folds(self, max_days: int | None = None, min_days: int | None = None, as_of: Day | None = None) -> Folds:
        """As ``features.folds_of_log`` of the log; conditions are constants on the partition column."""
        windowed = (max_days, min_days) != (None, None)
        today = as_of if as_of is not None else self.newest_day()

        def days(name: str, bounded: bool, most: int | None = None, least: int | None = None) -> DataFrame:
            table = self.table(name)
            if not bounded:
                return table
            if today is None:
                return table.limit(0)
            bounds = [F.col(DAY) <= F.expr(f"date_sub(date'{today}', {least or 0})")]
            if most is not None:
                bounds.append(F.col(DAY) >= F.expr(f"date_sub(date'{today}', {most})"))
            return table.where(reduce(Column.__and__, bounds))

        bounded = windowed or as_of is not None
        return Folds(
            days("sessions", bounded, max_days, min_days),
            merged_plays(days("plays", bounded, max_days, min_days)),
            merged_profile(days("profile", as_of is not None)),
            F.lit(today).cast("date"),
        )

    def feature_table(self, max_days: int | None = None, min_days: int | None = None, *, as_of: Day | None = None, **options) -> DataFrame:
        """The same rows as ``features.feature_table`` of the log the state was made from."""
        return features_of(self.folds(max_days, min_days, as_of), **options)
