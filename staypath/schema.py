"""Shape of the event log and the names every module shares."""

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("userId", T.StringType()),
    T.StructField("auth", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("userAgent", T.StringType()),
    T.StructField("registration", T.LongType()),
    T.StructField("level", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("sessionId", T.LongType()),
    T.StructField("itemInSession", T.LongType()),
    T.StructField("page", T.StringType()),
    T.StructField("artist", T.StringType()),
    T.StructField("song", T.StringType()),
    T.StructField("length", T.DoubleType()),
])

# Log vocabulary and output names that results must carry.
LOGGED_IN = "Logged In"
PAID = "paid"
FEMALE = "F"
PLAY_PAGE = "NextSong"
CANCEL_PAGE = "Cancel"
CHURN_PAGES = ["Cancel", "Submit Downgrade"]
DAY_PARTS = ["1am ~ 6am", "6am ~ 12pm", "12pm ~ 6pm", "6pm ~ 1am"]
DAY_PART_SHARES = ["perc_1_6", "perc_6_12", "perc_12_18", "perc_18_1"]
COUNTED_PAGES = {
    "thup": "Thumbs Up",
    "thdn": "Thumbs Down",
    "addlist": "Add to Playlist",
    "addfrd": "Add Friend",
    "error": "Error",
}
SHARED_PAGES = ["thup", "thdn", "addlist", "addfrd"]
LABEL = "last_status_cancelled"

USAGE_COLUMNS = [
    "sessions", "items", "active_days", "active_time",
    "sessions_per_day", "time_per_day", "avg_items_per_session", "time_per_session",
]
CONTENT_COLUMNS = ["unique_songs", "unique_artists", "max_song_perc"]
ACTION_COLUMNS = [
    "numbers_thup", "numbers_thdn", "numbers_addlist", "numbers_addfrd", "numbers_error",
    "perc_thup", "perc_thdn", "perc_addlist", "perc_addfrd",
]
MEMBERSHIP_COLUMNS = ["last_status_paid", "paid_days", "perc_paid_days"]

# The feature columns shown as histograms, and those shown in hours.
HISTOGRAM_COLUMNS = [
    "active_days", "sessions_per_day", "time_per_session", "time_per_day",
    "avg_items_per_session", "unique_songs", "unique_artists",
    "perc_1_6", "perc_6_12", "perc_12_18", "perc_18_1",
    "perc_addlist", "perc_thdn", "perc_thup", "perc_popular_songs",
    "perc_paid_days", "female", "last_status_paid", "customer_age",
]
HOUR_COLUMNS = ["time_per_session", "time_per_day"]
LABEL_PROFILE_COLUMNS = [
    "customer_age", "perc_1_6", "perc_addlist", "perc_12_18", "time_per_day", "perc_popular_songs",
]
