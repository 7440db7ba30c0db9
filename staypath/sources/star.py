"""The driver's star-schema tables as an event log.

The tables hold no music log; fixed arithmetic over ``events``, ``customer`` and ``nation`` makes
one that has every kind of odd row: missing and empty ids, logged-out rows, locations without a
state, missing agents, sessions over midnight. ``FIXTURES.md`` gives the same rules for both engines.
"""

from pyspark.sql import DataFrame, SparkSession

from staypath.schema import EVENT_SCHEMA

# the columns used, declared so that no job reads footers to find them
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}

# json_tuple is a generator: the text is parsed once per row, however often k is used below
PARSED = ["event_id", "user_id", "event_type", "value", "ts", "json_tuple(props, 'k') as k"]
RAW = [
    "event_id", "user_id", "event_type", "value", "bigint(k) as k",
    "unix_millis(cast(ts as timestamp)) as ms",
]

BEHAVIOUR = {
    "userId": "case when k >= 99 then null when k >= 98 then '' else string(user_id) end",
    "auth": "case when k >= 97 then 'Logged Out' else 'Logged In' end",
    "level": "case when k < 40 + user_id % 30 then 'paid' else 'free' end",
    "ts": "ms",
    "sessionId": "bigint(floor((ms + 10800000) / 43200000))",
    "itemInSession": "event_id",
    "page": """case event_type
        when 'view' then 'NextSong'
        when 'signup' then 'NextSong'
        when 'click' then case when k < 60 then 'Thumbs Up' else 'Thumbs Down' end
        when 'purchase' then case when k < 40 then 'Add to Playlist' when k < 60 then 'Add Friend'
                                  when k < 80 then 'Submit Downgrade' else 'Cancel' end
        else case when k < 50 then 'Error' when k < 75 then 'Submit Downgrade' else 'Cancel' end end""",
    "artist": "case when event_type in ('view', 'signup') then concat('Artist ', string(k % 17)) end",
    "song": "case when event_type in ('view', 'signup') then concat('Song ', string(k)) end",
    "length": "case when event_type in ('view', 'signup') then value end",
}

PROFILE = {
    "gender": """case when k >= 98 then null
        when c_mktsegment in ('HOUSEHOLD', 'FURNITURE') then 'F' else 'M' end""",
    "registration": "case when k >= 98 then null else 1704067200000 - (user_id % 60) * 86400000 end",
    "location": """case when user_id % 10 = 9 then null when user_id % 10 = 8 then 'Nowhere'
        else concat('City-Town, ', n_name, '-R', string(n_regionkey)) end""",
    "userAgent": """case c_mktsegment
        when 'MACHINERY' then 'Mozilla/5.0 (X11; Linux) Gecko/20100101 Firefox/31.0'
        when 'BUILDING' then null
        else '"Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/37.0 Safari/537.36"' end""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str, profile: bool = True) -> DataFrame:
    """Event log of one scale factor; needs the session time zone to be UTC.

    ``profile=False`` leaves the four profile columns null and with them out the joins to
    ``customer`` and ``nation``, which is what operators on behaviour want.
    """
    rows = table(spark, sf_dir, "events").selectExpr(*PARSED).selectExpr(*RAW)
    if profile:
        # two plain left joins: each right side is broadcast or not by its own file size
        people, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
        rows = rows.join(people, rows["user_id"] == people["c_custkey"], "left").join(
            nations, people["c_nationkey"] == nations["n_nationkey"], "left"
        )
    fields = BEHAVIOUR | (PROFILE if profile else dict.fromkeys(PROFILE, "null"))
    return rows.selectExpr(*[
        f"cast({fields[f.name]} as {f.dataType.simpleString()}) as {f.name}" for f in EVENT_SCHEMA
    ])
