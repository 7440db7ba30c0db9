"""Songs and artists per user: variety, concentration and popularity."""

from pyspark.sql import DataFrame, Window, functions as F

from staypath.functions.columns import length_sql, ratio
from staypath.operators.activity import IS_PLAY

# grouping_id of the two roll-ups below: a set bit marks a key that is rolled away
BY_SONG, BY_ARTIST = 1, 2
#: sums that a fold holds
FOLDED = ["n", "time", "plays", "play_time"]


def plays_fold(events: DataFrame, length_decimals: int | None = None, *keys: str) -> DataFrame:
    """One row per (user, artist, song) and any other ``keys``: rows, their length, and plays and their length."""
    length = length_sql("length", length_decimals)
    return (
        events.where("userId is not null")
        .select("userId", *keys, "artist", "singer_song", "length", F.expr(f"{IS_PLAY} as played"))
        .groupBy("userId", *keys, "artist", "singer_song")
        .agg(
            F.expr("count(*) as n"),
            F.expr(f"sum({length}) as time"),
            F.expr("count_if(played) as plays"),
            F.expr(f"sum(case when played then {length} end) as play_time"),
        )
    )


def merged_plays(fold: DataFrame) -> DataFrame:
    """One row per (user, artist, song) from folds of several days."""
    return fold.groupBy("userId", "artist", "singer_song").agg(*[F.expr(f"sum({c}) as {c}") for c in FOLDED])


def content_features(events: DataFrame, length_decimals: int | None = None) -> DataFrame:
    """``unique_songs, unique_artists, max_song_perc, max_artist_perc`` per user of the events."""
    return content_of(plays_fold(events, length_decimals))


def content_of(fold: DataFrame) -> DataFrame:
    """The same from :func:`plays_fold` rows, which feed (user, song) and (user, artist) totals; the user level only sees those."""
    user, song, artist = F.col("userId"), F.col("singer_song"), F.col("artist")
    heard = fold.groupingSets([[user, song], [user, artist]], user, song, artist).agg(
        F.expr("grouping_id() as kind"), *[F.expr(f"sum({c}) as {c}") for c in FOLDED]
    )
    song_time = f"case when kind = {BY_SONG} then time end"
    artist_time = f"case when kind = {BY_ARTIST} and plays > 0 then play_time end"
    return heard.groupBy("userId").agg(
        F.expr(f"count(case when kind = {BY_SONG} and n > 0 then singer_song end) as unique_songs"),
        F.expr(f"count(case when kind = {BY_ARTIST} then artist end) as unique_artists"),
        ratio(f"max({song_time})", f"sum({song_time})", "max_song_perc"),
        ratio(f"max({artist_time})", f"sum({artist_time})", "max_artist_perc"),
    )


def folded_song_plays(fold: DataFrame) -> DataFrame:
    """:func:`song_plays` from :func:`plays_fold` rows.

    Looks at every folded column, so that its input equals that of :func:`content_of` and Spark shuffles the fold once.
    """
    every = "case when n > 0 or time is not null or play_time is not null then plays end"
    played = fold.groupBy("userId", "singer_song").agg(F.expr(f"sum({every}) as plays"))
    return played.where("plays > 0")


def song_plays(events: DataFrame) -> DataFrame:
    """Plays per (user, song)."""
    plays = events.where(f"userId is not null and {IS_PLAY}")
    return plays.groupBy("userId", "singer_song").agg(F.expr("count(*) as plays"))


def listeners_per_song(plays: DataFrame) -> DataFrame:
    """Distinct listeners per song, from :func:`song_plays`.

    Counting ``plays > 0`` rather than rows keeps this branch's input equal to the one joined in
    :func:`popular_song_share`, so Spark shuffles the (user, song) rows once for both.
    """
    return plays.groupBy("singer_song").agg(F.expr("count_if(plays > 0) as listeners"))


def song_popularity(events: DataFrame) -> DataFrame:
    return listeners_per_song(song_plays(events))


def popularity_bar(popularity: DataFrame, relative_error: float | None = None) -> DataFrame:
    """One row ``bar``: the median listener count over songs (null if there are no songs).

    Exact by default: songs are first counted per listener number. The distinct listener numbers
    of N (user, song) pairs are fewer than sqrt(2N), which is all the ordered window has to hold.
    ``relative_error`` switches to the approximate percentile.
    """
    if relative_error is not None:
        accuracy = max(1, round(1 / relative_error))
        return popularity.agg(F.percentile_approx("listeners", 0.5, accuracy).alias("bar"))
    per_count = popularity.groupBy("listeners").agg(F.expr("count(*) as songs"))
    up_to = Window.orderBy("listeners").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = up_to.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = per_count.select(
        "listeners", F.sum("songs").over(up_to).alias("below"), F.sum("songs").over(every).alias("total")
    )
    return ranked.where("below * 2 >= total").agg(F.expr("min(listeners) as bar"))


def popular_songs(popularity: DataFrame, relative_error: float | None = None) -> DataFrame:
    """Songs whose listener count reaches the bar."""
    return popularity.where(F.col("listeners") >= popularity_bar(popularity, relative_error).scalar())


def popular_song_share(events: DataFrame, relative_error: float | None = None, hot_songs: int = 1000) -> DataFrame:
    """``perc_popular_songs``: share of a user's plays that are plays of popular songs."""
    return popular_share_of(song_plays(events), relative_error, hot_songs)


def popular_share_of(plays: DataFrame, relative_error: float | None = None, hot_songs: int = 1000) -> DataFrame:
    """The same from plays per (user, song).

    The join sees one row per (user, song) instead of one per play. A song with at least 1/1000 of
    these rows is hot; there can be no more than ``hot_songs`` = 1000 of them, so they are broadcast
    and their rows skip the shuffled join: they carry no song there and are scattered over
    ``slot``. No other song can make up more than 1/1000 of the shuffled rows.
    """
    popularity = listeners_per_song(plays)
    bar = popularity_bar(popularity, relative_error)
    pairs = popularity.agg(F.sum("listeners")).scalar()
    hot = popularity.where(F.col("listeners") * hot_songs >= pairs).select(
        F.expr("singer_song as hot_song"), (F.col("listeners") >= bar.scalar()).alias("hot_popular")
    )
    popular = popularity.where(F.col("listeners") >= bar.scalar()).select(
        F.expr("singer_song as cold_song"), F.expr("0L as slot"), F.expr("true as popular")
    )
    spread = plays.join(F.broadcast(hot), F.expr("singer_song = hot_song"), "left").select(
        "userId",
        "plays",
        "hot_popular",
        F.expr("case when hot_song is null then singer_song end as cold_song"),
        F.expr("case when hot_song is null then 0L else 1 + pmod(xxhash64(userId), 100000) end as slot"),
    )
    weight = "case when coalesce(hot_popular, popular, false) then plays else 0 end"
    return (
        spread.join(popular, ["cold_song", "slot"], "left")
        .groupBy("userId")
        .agg(ratio(f"sum({weight})", "sum(plays)", "perc_popular_songs"))
    )
