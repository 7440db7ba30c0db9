"""DuckDB SQL for the registered queries, written independently of the Spark plans.

Every statement starts from the same event log, which is derived from ``events``, ``customer`` and
``nation``; see ``FIXTURES.md``.
"""

import math

# Columns shown as histograms, and columns averaged per label.
HISTOGRAM_COLUMNS = [
    "active_days", "sessions_per_day", "time_per_session", "time_per_day",
    "avg_items_per_session", "unique_songs", "unique_artists",
    "perc_1_6", "perc_6_12", "perc_12_18", "perc_18_1",
    "perc_addlist", "perc_thdn", "perc_thup", "perc_popular_songs",
    "perc_paid_days", "female", "last_status_paid", "customer_age",
]
LABEL_PROFILE_COLUMNS = [
    "customer_age", "perc_1_6", "perc_addlist", "perc_12_18", "time_per_day", "perc_popular_songs",
]

# The split seed, and the cumulative Poisson probabilities for a mean of 3.01.
SPLIT_SEED = 100
POISSON_3_01 = [
    0.04929167876046217,
    0.1976596318294533,
    0.4209534011982849,
    0.6449914831316792,
    0.8135801397865584,
    0.9150705110927957,
    0.9659848473647581,
    0.9878780119617019,
    0.996115315141302,
    0.9988702354269239,
    0.9996994664328961,
    0.9999263741899849,
    0.9999832902190546,
    0.9999964684688624,
    0.999999301792571,
    0.9999998703461952,
    0.9999999773053457,
    0.9999999962434071,
    0.9999999994102717,
    0.9999999999119698,
    0.9999999999874754,
    0.9999999999982978,
    0.9999999999997785,
    0.9999999999999722,
    0.9999999999999966,
    0.9999999999999994,
    0.9999999999999998,
    0.9999999999999998,
    0.9999999999999998,
]

LOG = """
with raw as (
  select event_id, user_id, event_type, value,
         cast(json_extract_string(props, '$.k') as bigint) as k, epoch_us(ts) // 1000 as ms
  from events
),
log as (
  select
    case when k >= 99 then null when k >= 98 then '' else cast(r.user_id as varchar) end as userId,
    case when k >= 97 then 'Logged Out' else 'Logged In' end as auth,
    case when k >= 98 then null when c.c_mktsegment in ('HOUSEHOLD', 'FURNITURE') then 'F' else 'M' end as gender,
    case when k >= 98 then null else 1704067200000 - (r.user_id % 60) * 86400000 end as registration,
    case when k < 40 + r.user_id % 30 then 'paid' else 'free' end as level,
    r.ms as ts,
    cast(floor((r.ms + 10800000) / 43200000) as bigint) as sessionId,
    r.event_id as itemInSession,
    case r.event_type
      when 'view' then 'NextSong'
      when 'signup' then 'NextSong'
      when 'click' then case when k < 60 then 'Thumbs Up' else 'Thumbs Down' end
      when 'purchase' then case when k < 40 then 'Add to Playlist' when k < 60 then 'Add Friend'
                                when k < 80 then 'Submit Downgrade' else 'Cancel' end
      else case when k < 50 then 'Error' when k < 75 then 'Submit Downgrade' else 'Cancel' end
    end as page,
    case when r.event_type in ('view', 'signup') then concat('Artist ', cast(k % 17 as varchar)) end as artist,
    case when r.event_type in ('view', 'signup') then concat('Song ', cast(k as varchar)) end as song,
    case when r.event_type in ('view', 'signup') then r.value end as length,
    case when r.user_id % 10 = 9 then null when r.user_id % 10 = 8 then 'Nowhere'
         else 'City-Town, ' || n.n_name || '-R' || cast(n.n_regionkey as varchar) end as location,
    case c.c_mktsegment
      when 'MACHINERY' then 'Mozilla/5.0 (X11; Linux) Gecko/20100101 Firefox/31.0'
      when 'BUILDING' then null
      else '"Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/37.0 Safari/537.36"' end
      as userAgent
  from raw r
  left join customer c on c.c_custkey = r.user_id
  left join nation n on n.n_nationkey = c.c_nationkey
)"""

LOG_END = "left join nation n on n.n_nationkey = c.c_nationkey\n)"
TODAY = "today as (select max(cast(make_timestamp(ts * 1000) as date)) as day from log where auth = 'Logged In')"

ACT = """,
today as (select max(cast(make_timestamp(ts * 1000) as date)) as day from log where auth = 'Logged In'),
act as (
  select userId, registration, cast(make_timestamp(registration * 1000) as date) as registration_date,
         level, ts as time, cast(make_timestamp(ts * 1000) as date) as event_date,
         case when hour(make_timestamp(ts * 1000)) in (1, 2, 3, 4, 5, 6) then '1am ~ 6am'
              when hour(make_timestamp(ts * 1000)) in (7, 8, 9, 10, 11, 12) then '6am ~ 12pm'
              when hour(make_timestamp(ts * 1000)) in (13, 14, 15, 16, 17, 18) then '12pm ~ 6pm'
              else '6pm ~ 1am' end as time_in_the_day,
         sessionId, itemInSession, page, artist, artist || ' - ' || song as singer_song, length,
         cast(date_diff('day', cast(make_timestamp(registration * 1000) as date),
                        cast(make_timestamp(ts * 1000) as date)) as integer) as days_since_registration,
         cast(date_diff('day', cast(make_timestamp(ts * 1000) as date), today.day) as integer) as days_before_today
  from log, today
  where auth = 'Logged In'
)"""

# the activity restricted to a window takes the place of ACT's table in the parts below
SEEN = """,
seen as (select * from act where userId is not null{window})"""

USAGE = """,
per_session as (
  select userId, sessionId, count(*) as n, max(time) - min(time) as span from seen group by all
),
f_session as (
  select userId, count(*) as sessions, cast(sum(n) as bigint) as items, cast(sum(span) as bigint) as active_time,
         avg(n) as avg_items_per_session, avg(span) as time_per_session
  from per_session group by userId
),
per_day_session as (
  select userId, event_date, sessionId, max(time) - min(time) as span from seen group by all
),
per_day as (
  select userId, event_date, count(*) as n, cast(sum(span) as bigint) as span from per_day_session group by all
),
f_day as (
  select userId, count(*) as active_days, avg(n) as sessions_per_day, avg(span) as time_per_day
  from per_day group by userId
),
per_part as (
  select userId, sessionId, time_in_the_day as part, max(time) - min(time) as span from seen group by all
),
part_sums as (
  select userId, sum(span) as whole,
         sum(case when part = '1am ~ 6am' then span else 0 end) as a,
         sum(case when part = '6am ~ 12pm' then span else 0 end) as b,
         sum(case when part = '12pm ~ 6pm' then span else 0 end) as c,
         sum(case when part = '6pm ~ 1am' then span else 0 end) as d
  from per_part group by userId
),
f_part as (
  select userId,
         cast(a as double) / nullif(cast(whole as double), 0) as perc_1_6,
         cast(b as double) / nullif(cast(whole as double), 0) as perc_6_12,
         cast(c as double) / nullif(cast(whole as double), 0) as perc_12_18,
         cast(d as double) / nullif(cast(whole as double), 0) as perc_18_1
  from part_sums
)"""

CONTENT = """,
f_variety as (
  select userId, count(distinct singer_song) as unique_songs, count(distinct artist) as unique_artists
  from seen group by userId
),
song_time as (
  select userId, singer_song, sum(cast(round(length * 100) as bigint)) as t from seen group by all
),
f_song as (
  select userId, cast(max(t) as double) / nullif(cast(sum(t) as double), 0) as max_song_perc
  from song_time group by userId
),
artist_time as (
  select userId, artist, sum(cast(round(length * 100) as bigint)) as t
  from seen where singer_song is not null and page = 'NextSong' group by all
),
f_artist as (
  select userId, cast(max(t) as double) / nullif(cast(sum(t) as double), 0) as max_artist_perc
  from artist_time group by userId
)"""

ACTIONS = """,
f_actions as (
  select userId,
         count(*) filter (page = 'Thumbs Up') as numbers_thup,
         count(*) filter (page = 'Thumbs Down') as numbers_thdn,
         count(*) filter (page = 'Add to Playlist') as numbers_addlist,
         count(*) filter (page = 'Add Friend') as numbers_addfrd,
         count(*) filter (page = 'Error') as numbers_error,
         cast(count(*) filter (page = 'Thumbs Up') as double) / cast(count(*) as double) as perc_thup,
         cast(count(*) filter (page = 'Thumbs Down') as double) / cast(count(*) as double) as perc_thdn,
         cast(count(*) filter (page = 'Add to Playlist') as double) / cast(count(*) as double) as perc_addlist,
         cast(count(*) filter (page = 'Add Friend') as double) / cast(count(*) as double) as perc_addfrd
  from seen group by userId
)"""

POPULARITY = """,
plays as (select userId, singer_song from seen where singer_song is not null and page = 'NextSong'),
popularity as (select singer_song, count(distinct userId) as listeners from plays group by singer_song),
bar as (select quantile_disc(listeners, 0.5) as bar from popularity),
f_popular as (
  select p.userId,
         cast(count(*) filter (s.listeners >= bar.bar) as double) / cast(count(*) as double) as perc_popular_songs
  from plays p join popularity s using (singer_song), bar
  group by p.userId
)"""

MEMBERSHIP = """,
ranked as (
  select userId, level, page, row_number() over (partition by userId order by time desc, itemInSession desc) as r
  from seen
),
f_last as (select userId, cast(level = 'paid' as integer) as last_status_paid from ranked where r = 1),
day_status as (select distinct userId, event_date, cast(level = 'paid' as integer) as paid from seen),
f_paid as (
  select userId, cast(sum(paid) as bigint) as paid_days,
         cast(sum(paid) as double) / cast(count(*) as double) as perc_paid_days
  from day_status group by userId
)"""

LABEL = """,
label_ranked as (
  select userId, page, row_number() over (partition by userId order by time desc, itemInSession desc) as r
  from act where userId is not null{window}
),
label as (
  select userId, cast(page in ('Cancel', 'Submit Downgrade') as integer) as last_status_cancelled
  from label_ranked where r = 1
)"""

AGENTS = ["AppleWebKit", "Chrome", "Firefox", "Gecko", "Mozilla", "Safari"]
STATES = sorted([f"NATION_{i}" for i in range(25)] + [f"R{i}" for i in range(5)])

PARSED = """,
agent_words as (
  select distinct userId, unnest(string_split_regex(
    replace(regexp_replace(userAgent, '[(\\[].*?[)\\]]', '', 'g'), '"', ''), '\\s+')) as word
  from log where userId is not null and userAgent is not null
),
agent_tokens as (
  select distinct userId, split_part(word, '/', 1) as agent from agent_words where word <> '' and word <> 'like'
),
state_tokens as (
  select distinct userId, unnest(string_split(replace(split_part(location, ',', 2), ' ', ''), '-')) as state
  from log where userId is not null and location like '%,%'
)"""


def _wide(table, column, values):
    counts = ",\n".join(f"  count(*) filter ({column} = '{v}') as {column}_{v}" for v in values)
    return f"select userId,\n{counts}\nfrom {table} group by userId"


STATIC = PARSED + f""",
f_agents as ({_wide('agent_tokens', 'agent', AGENTS)}),
f_people as (
  select userId, max(case when gender = 'F' then 1 else 0 end) as female,
         cast(date_diff('day', min(cast(make_timestamp(registration * 1000) as date)), max(today.day)) as integer)
           as customer_age
  from log, today where userId is not null group by userId
)"""

STATIC_BODY = """
select p.userId, p.female, p.customer_age, a.* exclude (userId) from f_people p left join f_agents a using (userId)"""

DYNAMIC_COLUMNS = """
  s.sessions, s.items, d.active_days, s.active_time, d.sessions_per_day, d.time_per_day,
  s.avg_items_per_session, s.time_per_session, t.perc_1_6, t.perc_6_12, t.perc_12_18, t.perc_18_1,
  v.unique_songs, v.unique_artists, g.max_song_perc, {extra}
  n.* exclude (userId), o.perc_popular_songs, l.last_status_paid, m.paid_days, m.perc_paid_days"""

DYNAMIC_FROM = """
from f_session s
join f_day d using (userId)
join f_part t using (userId)
join f_variety v using (userId)
join f_song g using (userId)
left join f_artist h using (userId)
join f_actions n using (userId)
left join f_popular o using (userId)
join f_last l using (userId)
join f_paid m using (userId)"""


def seen(window=""):
    return LOG + ACT + SEEN.format(window=window)


def features(window="", artist=False):
    """CTE ``features``: the full feature table."""
    extra = "h.max_artist_perc," if artist else ""
    return (
        seen(window) + USAGE + CONTENT + ACTIONS + POPULARITY + MEMBERSHIP + STATIC
        + f""",
static as ({STATIC_BODY}),
dynamic as (select s.userId, {DYNAMIC_COLUMNS.format(extra=extra)} {DYNAMIC_FROM}),
features as (select * from static full join dynamic using (userId))"""
    )


FEATURE_NUMBERS = (
    ["female", "customer_age"] + [f"agent_{a}" for a in AGENTS]
    + ["sessions", "items", "active_days", "active_time", "sessions_per_day", "time_per_day",
       "avg_items_per_session", "time_per_session", "perc_1_6", "perc_6_12", "perc_12_18", "perc_18_1",
       "unique_songs", "unique_artists", "max_song_perc",
       "numbers_thup", "numbers_thdn", "numbers_addlist", "numbers_addfrd", "numbers_error",
       "perc_thup", "perc_thdn", "perc_addlist", "perc_addfrd", "perc_popular_songs",
       "last_status_paid", "paid_days", "perc_paid_days"]
)


def training(window="", label_window="", excluded="0"):
    """CTE ``training``: features without one user, nulls as 0, joined with the label."""
    filled = ", ".join(f"coalesce({c}, 0) as {c}" for c in FEATURE_NUMBERS)
    return (
        features(window) + LABEL.format(window=label_window)
        + f""",
training as (
  select f.userId, {filled}, last_status_cancelled
  from features f join label using (userId) where f.userId <> '{excluded}'
)"""
    )


CURVE = """,
counted as (
  select perc_thdn as threshold,
         count(*) filter (last_status_cancelled = 1) as pos, count(*) filter (last_status_cancelled = 0) as neg
  from training group by 1
),
curve as (
  select threshold, pos, neg, sum(pos) over (order by threshold desc) as tp, sum(neg) over (order by threshold desc) as fp,
         sum(pos) over () as all_pos, sum(neg) over () as all_neg
  from counted
)"""


def draw(purpose, seed):
    return f"(cast(('0x' || substr(md5(userId || ':{purpose}:{seed}'), 1, 13)) as bigint) / 4503599627370496.0)"


def drawn(table, minority, majority, seed, jitter=0.01):
    """Body: rows of ``table`` with the number of times resampling takes them."""
    steps = " + ".join(f"cast(u >= {step!r}::double as integer)" for step in POISSON_3_01)
    return f"""
select userId, label, copy from (
  select userId, label, unnest(range(1, 1 + case when label = 1 then {steps}
                                             else cast(u < {majority - jitter!r}::double as integer) end)) as copy
  from (select userId, last_status_cancelled as label, {draw('sample', seed)} as u from {table})
)"""


def scaling(minority, majority, jitter=0.01):
    """Body: deviation of every feature over the resampled training part, to nine digits."""
    steps = " + ".join(f"cast(u >= {step!r}::double as integer)" for step in POISSON_3_01)
    columns = ", ".join(f"cast({c} as double) as {c}" for c in FEATURE_NUMBERS)
    return f""",
train as (
  select {columns}, last_status_cancelled as label, {draw('sample', 0)} as u from training where {draw('split', SPLIT_SEED)} < 0.7::double
),
train_drawn as (
  select * exclude (label, u), unnest(range(case when label = 1 then {steps}
                                               else cast(u < {majority - jitter!r}::double as integer) end)) as copy
  from train
)
select feature, printf('%.8e', stddev_samp(v)) as deviation
from (unpivot (select * exclude (copy) from train_drawn) on {', '.join(FEATURE_NUMBERS)} into name feature value v)
group by feature"""


def histogram(bins=10):
    parts = []
    for c in HISTOGRAM_COLUMNS:
        value = f"{c} / 3600000.0::double" if c in ("time_per_session", "time_per_day") else f"cast({c} as double)"
        parts.append(f"select '{c}' as feature, {value} as v from features")
    return features() + ",\nlong as (" + "\nunion all ".join(parts) + f"""),
span as (
  select feature, case when min(v) = max(v) then min(v) - 0.5 else min(v) end as lo,
         case when min(v) = max(v) then max(v) + 0.5 else max(v) end as hi
  from long where v is not null group by feature
),
slot as (
  select feature, cast(least(floor((v - lo) / (hi - lo) * {bins}) + 1, {bins}) as integer) as bin
  from long join span using (feature) where v is not null
)
select s.feature, cast(b.bin as integer) as bin, lo + (hi - lo) / {bins} * (b.bin - 1) as lower,
       case when b.bin = {bins} then hi else lo + (hi - lo) / {bins} * b.bin end as upper,
       (select count(*) from slot x where x.feature = s.feature and x.bin = b.bin) as n
from span s, (select unnest(range(1, {bins} + 1)) as bin) b"""


def at_day(sql: str, day: str) -> str:
    """The same statement as seen at a past day: later events are left out, and that day is today."""
    sql = sql.replace("\nlog as (", "\nwhole_log as (", 1).replace(
        LOG_END, f"{LOG_END},\nlog as (select * from whole_log where cast(make_timestamp(ts * 1000) as date) <= date '{day}')", 1)
    return sql.replace(TODAY, f"today as (select date '{day}' as day)", 1)


def poisson(rate: float) -> list[float]:
    """Cumulative Poisson probabilities as far as doubles tell them from 1."""
    steps, total, k = [], 0.0, 0
    while k < 60 and total < 1 - 1e-15:
        total += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
        steps.append(total)
        k += 1
    return steps


def run_sizes(multipliers=(3.0, 2.0, 1.5, 1.0), runs=3) -> str:
    """Body: sizes of the training part of each run."""
    lines = []
    for m in multipliers:
        steps = " + ".join(f"cast(u >= {step!r}::double as integer)" for step in poisson(m + 0.01))
        for run in range(runs):
            lines.append(f"""
select {m!r}::double as multiplier, {run} as run, cast(coalesce(sum(case when label = 1 then {steps} end), 0) as bigint) as n_pos,
       cast(coalesce(sum(case when label = 0 then cast(u < 0.99::double as integer) end), 0) as bigint) as n_neg
from (select last_status_cancelled as label, {draw('sample', run)} as u from training where {draw('split', SPLIT_SEED)} < 0.7::double)""")
    return "\nunion all".join(lines)


def statements() -> dict[str, str]:
    rounded_means = ", ".join(f"cast(round(cast(avg(agent_{a}) as decimal(18, 10)), 2) as double) as agent_{a}"
                              for a in AGENTS)
    label_means = ", ".join(f"round(avg({c}), 6) as mean_{c}" for c in LABEL_PROFILE_COLUMNS)
    null_columns = ["female", "customer_age"]
    gap = training(" and days_before_today >= 14", " and days_before_today <= 7", "0")
    feature_columns = ["userId"] + FEATURE_NUMBERS
    sql = {
        "dataset_summary": LOG + """
select count(*) as n_rows, count(*) filter (userId is null) as null_user_rows,
       count(distinct userId) + cast(count(*) filter (userId is null) > 0 as integer) as users
from log""",
        "page_counts": LOG + "\nselect page, count(*) as n from log group by page",
        "auth_counts": LOG + "\nselect auth, count(*) as n from log group by auth",
        "top_songs": LOG + """
select artist || ' - ' || song as singer_song, count(*) as n from log where song is not null
group by 1 order by n desc, singer_song limit 10""",
        "max_days_back": LOG + ACT + "\nselect max(days_before_today) as max_days_before_today from act",
        "null_user_rows": LOG + "\nselect * from log where userId is null",
        "activity": LOG + ACT + """
select * replace (cast(registration_date as varchar) as registration_date,
                  cast(event_date as varchar) as event_date) from act""",
        "activity_window": LOG + ACT + """
select userId, time, page, days_before_today from act where days_before_today between 3 and 14""",
        "customer_ages": LOG + """
select distinct userId, cast(date_diff('day', cast(make_timestamp(registration * 1000) as date),
                                       date '2024-02-01') as integer) as days_till_as_of
from log""",
        "post_cancel_events": LOG + ACT + """,
numbered as (
  select *, row_number() over (partition by userId order by time desc, itemInSession desc) as r
  from act where userId is not null
)
select userId, sessionId, itemInSession, time, page, level from numbered where r <> 1 and page = 'Cancel'""",
        "agent_tokens": LOG + PARSED + "\nselect userId, agent from agent_tokens",
        "agent_onehot": LOG + PARSED + "\n" + _wide("agent_tokens", "agent", AGENTS),
        "agent_share": LOG + PARSED + f"""
select {rounded_means} from ({_wide('agent_tokens', 'agent', AGENTS)})""",
        "state_tokens": LOG + PARSED + "\nselect userId, state from state_tokens",
        "state_onehot": LOG + PARSED + "\n" + _wide("state_tokens", "state", STATES),
        "static_profile": LOG + ACT + STATIC + STATIC_BODY,
        "session_usage": seen() + USAGE + "\nselect * from f_session",
        "day_usage": seen() + USAGE + "\nselect * from f_day",
        "time_of_day": seen() + USAGE + "\nselect * from f_part",
        "song_variety": seen() + CONTENT + "\nselect * from f_variety",
        "song_concentration": seen() + CONTENT + "\nselect * from f_song",
        "artist_concentration": seen() + CONTENT + """
select userId, max_artist_perc from (select distinct userId from seen) left join f_artist using (userId)""",
        "action_counts": seen() + ACTIONS + "\nselect * from f_actions",
        "song_popularity": seen() + POPULARITY + "\nselect * from popularity",
        "popular_songs": seen() + POPULARITY
        + "\nselect singer_song, listeners from popularity, bar where listeners >= bar.bar",
        "popular_song_share": seen() + POPULARITY + "\nselect * from f_popular",
        "membership": seen() + MEMBERSHIP + "\nselect * from f_last join f_paid using (userId)",
        "churn_label": LOG + ACT + LABEL.format(window="") + "\nselect * from label",
        "churn_rate": LOG + ACT + LABEL.format(window="") + """
select cast(sum(last_status_cancelled) as bigint) as churned_users, count(*) as users,
       cast(sum(last_status_cancelled) as double) / cast(count(*) as double) as churn_rate
from label""",
        "label_checks": LOG + ACT + LABEL.format(window="") + """
select count(*) as label_rows, count(distinct userId) as label_users from label""",
        "feature_table": features() + "\nselect * from features",
        "feature_table_window": features(" and days_before_today between 7 and 20") + "\nselect * from features",
        "feature_table_extended": features(artist=True) + f""",
states as ({_wide('state_tokens', 'state', STATES)})
select *, cast(active_days as double) / nullif(cast(customer_age as double), 0) as active_day_share
from features left join states using (userId)""",
        "training_set": training() + "\nselect * from training",
        "training_set_gap": gap + "\nselect * from training",
        "null_audit": features() + "\nselect "
        + ", ".join(f"count(*) filter ({c} is null) as {c}" for c in null_columns) + " from features",
        "null_age_users": features() + "\nselect * from features where customer_age is null",
        "feature_histogram": histogram(),
        "null_columns": features() + "\nselect cast("
        + " + ".join(f"cast(count(*) filter ({c} is null) > 0 as integer)" for c in feature_columns)
        + " as integer) as columns_with_nulls from features",
        "threshold_shares": features() + """
select cast(count(*) filter (active_days > 10) as double) / count(*) as active_over_10_days,
       cast(count(*) filter (sessions_per_day > 1) as double) / count(*) as over_1_session_per_day,
       cast(count(*) filter (time_per_day / 3600000.0::double > 3) as double) / count(*) as over_3_hours_per_day,
       cast(count(*) filter (perc_paid_days = 1) as double) / count(*) as always_paid
from features""",
        "label_balance": training() + """
select last_status_cancelled as label, count(*) as n from training group by 1""",
        "label_profile": training() + f"""
select last_status_cancelled as label, {label_means} from training group by 1""",
        "roc_curve": training() + CURVE + """
select threshold, cast(fp as double) / nullif(cast(all_neg as double), 0) as fpr,
       cast(tp as double) / nullif(cast(all_pos as double), 0) as tpr from curve""",
        "pr_curve": training() + CURVE + """
select threshold, cast(tp as double) / nullif(cast(all_pos as double), 0) as recall,
       cast(tp as double) / nullif(cast(tp + fp as double), 0) as precision from curve""",
        "auc": training() + CURVE + """
select cast(sum(neg * (2 * tp - pos)) as double)
       / nullif(cast(max(all_pos) as double) * cast(max(all_neg) as double) * 2, 0) as auc from curve""",
        "resample": training() + drawn("training", 3, 1, 0),
        "train_test": training() + f"""
select userId, last_status_cancelled as label, case when {draw('split', SPLIT_SEED)} < 0.7::double then 'train' else 'test' end
       as part
from training""",
    }
    sql["scaling"] = training() + scaling(3, 1)
    steps = " + ".join(f"cast(u >= {step!r}::double as integer)" for step in POISSON_3_01)
    sql["scaled_train_test"] = training() + f""",
parted as (
  select last_status_cancelled as label, {draw('sample', 0)} as u,
         case when {draw('split', SPLIT_SEED)} < 0.7::double then 'train' else 'test' end as part
  from training
)
select part, label, cast(sum(case when part = 'test' then 1 when label = 1 then {steps}
                                  else cast(u < 0.99::double as integer) end) as bigint) as n
from parted group by part, label"""
    past = "2024-01-20"
    sql["feature_table_past"] = at_day(features(" and days_before_today <= 10") + "\nselect * from features", past)
    sql["activity_past"] = at_day(LOG + ACT + """
select userId, time, page, days_before_today from act where days_before_today between 1 and 5""", past)
    sql["churn_label_past"] = at_day(LOG + ACT + LABEL.format(window=" and days_before_today <= 10") + "\nselect * from label", past)
    sql["feature_table_fitted"] = features() + f""",
states as ({_wide('state_tokens', 'state', STATES)})
select * from features left join states using (userId)"""
    sql["state_feature_table"] = sql["state_by_days"] = sql["feature_table"]
    sql["state_feature_table_window"] = sql["feature_table_window"]
    sql["state_feature_table_past"] = sql["feature_table_past"]
    for name in ("agent", "state"):
        words = f"""
select {name} as value, row_number() over (order by {name}) - 1 as position, count(*) as users from {name}_tokens group by {name}"""
        sql[f"{name}_dictionary"] = LOG + PARSED + words
        sql[f"{name}_vectors"] = LOG + PARSED + f""",
known as ({words})
select userId, cast((select count(*) from known) as integer) as size, string_agg(cast(position as varchar), ',' order by position) as positions,
       string_agg('1', ',' order by position) as counts
from {name}_tokens join known on value = {name} group by userId"""
    whole = "itemInSession % 50 not in (0, 1, 2)"
    sql["log_rejects"] = LOG + f"""
select case when itemInSession % 50 in (0, 2) then 'broken' when itemInSession % 50 = 1 then 'type' else 'event' end as reason, count(*) as n
from log group by 1"""
    sql["checked_log"] = LOG + f"\nselect * from log where {whole}"
    sql["features_csv_one_file"] = sql["feature_table"]
    sql["sampling_run_sizes"] = training() + run_sizes()
    names = ", ".join(f"'{c}'" for c in ["(intercept)", *FEATURE_NUMBERS])
    sql["lr_optimum"] = f"select unnest([{names}]) as feature, true as at_optimum"
    sql["tree_scores"] = training() + f""",
tested as (select count(*) as n from training where not ({draw('split', SPLIT_SEED)} < 0.7::double))
select model, part, if(part = 'scores', n, {len(FEATURE_NUMBERS)}) as n, if(part = 'scores', n, {len(FEATURE_NUMBERS)}) as n_equal
from tested, (select unnest(['forest', 'boosted']) as model), (select unnest(['scores', 'importances']) as part)"""
    bar = seen() + POPULARITY + "\nselect bar from bar"
    sql["popularity_bar"] = sql["popularity_bar_approx"] = bar
    sql["log_preview"] = LOG + ACT + """
select * replace (cast(registration_date as varchar) as registration_date, cast(event_date as varchar) as event_date) from act
order by md5(concat(coalesce(userId, ''), '|', coalesce(cast(time as varchar), ''), '|', coalesce(cast(itemInSession as varchar), ''))) limit 10"""
    sql["agent_onehot_fitted"] = sql["agent_onehot"]
    sql["agent_onehot_other"] = LOG + PARSED + """
select userId, count(*) filter (agent = 'Chrome') as agent_Chrome, count(*) filter (agent <> 'Chrome') as agent_other
from agent_tokens group by userId"""
    sql["events_of_user"] = LOG + ACT + "\nselect userId, time, page, level from act where userId = '7'"
    sql["event_log_json"] = LOG + "\nselect * from log"
    sql["features_csv"] = sql["feature_table"]
    sql["training_parquet"] = sql["training_set"]
    return sql
