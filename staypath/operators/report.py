"""Tables behind the feature plots."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from staypath.functions.columns import ratio
from staypath.operators.explore import null_counts
from staypath.schema import HISTOGRAM_COLUMNS, HOUR_COLUMNS

MS_PER_HOUR = 1000 * 60 * 60


def hours_sql(millis: str) -> str:
    return f"{millis} / {MS_PER_HOUR}"


def feature_histogram(
    features: DataFrame,
    columns: Sequence[str] = tuple(HISTOGRAM_COLUMNS),
    bins: int = 10,
    hour_columns: Sequence[str] = tuple(HOUR_COLUMNS),
) -> DataFrame:
    """Equal-width histogram of every column: ``feature, bin, lower, upper, n``, empty bins included.

    The last bin is closed; a column with a single value gets a range of one around it, and nulls
    are left out. ``features`` is read once: it is folded to how often each value of a column occurs, and ranges and bins
    both come from that fold, which is shuffled once. The range table has one row per column.
    """
    columns = list(columns)
    values = features.select(*[
        F.expr(f"double({hours_sql(f'`{c}`') if c in hour_columns else f'`{c}`'})").alias(c) for c in columns
    ])
    long = values.unpivot([], [f"`{c}`" for c in columns], "feature", "value").where("value is not null")
    fold = long.groupBy("feature", "value").agg(F.expr("count(*) as n"))
    # looking at n keeps this branch's input equal to the one joined below, so Spark shuffles the fold once
    ranges = fold.groupBy("feature").agg(
        F.expr("min(case when n > 0 then value end) as lo"), F.expr("max(case when n > 0 then value end) as hi")
    ).selectExpr("feature", "if(lo = hi, lo - 0.5D, lo) as lo", "if(lo = hi, hi + 0.5D, hi) as hi")
    counted = (
        fold.join(F.broadcast(ranges), "feature")  # one row per requested column
        .groupBy("feature", F.expr(f"int(least(floor((value - lo) / (hi - lo) * {bins}) + 1, {bins})) as bin"))
        .agg(F.expr("sum(n) as n"))
    )
    frame = ranges.selectExpr("feature", f"explode(sequence(1, {bins})) as bin", "lo", "hi")
    return frame.join(counted, ["feature", "bin"], "left").selectExpr(
        "feature",
        "bin",
        f"lo + (hi - lo) / {bins} * (bin - 1) as lower",
        f"if(bin = {bins}, hi, lo + (hi - lo) / {bins} * bin) as upper",
        "coalesce(n, 0) as n",
    )


def columns_with_nulls(features: DataFrame) -> DataFrame:
    """Number of columns that hold any null."""
    counts = null_counts(features)
    held = F.array(*[F.col(f"`{c}`") for c in counts.columns])
    return counts.select(F.size(F.filter(held, lambda n: n > 0)).alias("columns_with_nulls"))


def threshold_shares(features: DataFrame) -> DataFrame:
    """Shares of all users past four activity thresholds."""
    # The four thresholds.
    rules = {
        "active_over_10_days": "active_days > 10",
        "over_1_session_per_day": "sessions_per_day > 1",
        "over_3_hours_per_day": f"{hours_sql('time_per_day')} > 3",
        "always_paid": "perc_paid_days = 1",
    }
    return features.agg(*[ratio(f"count_if({rule})", "count(*)", name) for name, rule in rules.items()])
